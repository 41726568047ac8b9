"""Tool calls over all conversations.

The conversations hold plain turns, so tool messages are derived from them.  A user's
turn becomes a call of ``reply`` that names the reply two turns before, and the turn of
the assistant after it is its result.  A system turn becomes a call of ``instruct``.
Every chat begins with a call of ``outline`` that needs the last reply, which comes
later, so that the order of the calls is not that of the turns.

Turns of another role or of none give no message and count in the turns of the outline.
A null conv_id or turn makes the ids null, and a result without an id is an orphan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import table
from clamor.llm.tool_calls import link_tool_calls

# name, parameter, type, required
PARAMETERS = [
    ("reply", "question", "string", True),
    ("reply", "chars", "integer", True),
    ("reply", "after", "string", False),
    ("instruct", "text", "string", True),
    ("outline", "last", "string", True),
    ("outline", "turns", "integer", False),
]


def _id(kind: str, turn):
    return F.concat(F.lit(f"{kind}-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))


def _call(call_id, name: str, *arguments):
    call = F.struct(F.struct(*arguments).alias("arguments"), call_id.alias("id"), F.lit(name).alias("name"))
    return F.to_json(F.struct(F.array(call).alias("tool_calls")))


def tool_messages(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the derived messages."""
    turn = F.col("turn")
    before = F.when(turn >= 2, F.concat(F.lit("${"), _id("r", turn - 2), F.lit("}")))
    reply = _call(
        _id("r", turn), "reply", before.alias("after"),
        F.length("text").alias("chars"), F.col("text").alias("question"),
    )
    instruct = _call(_id("s", turn), "instruct", F.col("text"))
    result = F.to_json(
        F.struct(F.col("text").alias("content"), _id("r", turn - 1).alias("tool_call_id"))
    )
    # Without both it would be an empty object, which is no result.
    result = F.when(
        F.col("text").isNull() & _id("r", turn - 1).isNull(), F.lit('{"tool_call_id":null}')
    ).otherwise(result)
    role = F.col("role")
    said = turns.filter(role.isin("user", "system", "assistant")).select(
        "conv_id", "turn",
        F.when(role == "assistant", "tool").otherwise("assistant").alias("role"),
        F.when(role == "user", reply).when(role == "system", instruct).otherwise(result).alias("text"),
    )
    chats = turns.groupBy("conv_id").agg(
        F.min("turn").alias("turn"),
        F.max(F.when(role == "user", turn)).alias("last"),
        F.count("*").alias("turns"),
    )
    last = F.concat(F.lit("${"), _id("r", F.col("last")), F.lit("}"))
    outline = _call(_id("o", F.col("turn")), "outline", last.alias("last"), F.col("turns"))
    return said.unionAll(
        chats.select("conv_id", "turn", F.lit("assistant").alias("role"), outline.alias("text"))
    )


def op4_chat_tool_calls(spark, sf_dir):
    parameters = spark.createDataFrame(
        PARAMETERS, "name string, parameter string, type string, required boolean"
    )
    return link_tool_calls(tool_messages(table(spark, sf_dir, "conversations")), parameters)


ORACLE = """
WITH
turns AS (SELECT conv_id, turn, role, text FROM conversations),
reply AS (SELECT * FROM turns WHERE role = 'user'),
answer AS (SELECT * FROM turns WHERE role = 'assistant'),
chat AS (
  SELECT conv_id, min(turn) AS turn, max(turn) FILTER (role = 'user') AS last, count(*) AS turns
  FROM turns GROUP BY conv_id
),
replies AS (
  SELECT r.conv_id, r.turn, 'r-' || r.conv_id || '-' || r.turn AS call_id, 'reply' AS name,
    a.turn IS NOT NULL AS answered, a.text AS result,
    CASE WHEN r.text IS NULL THEN 'missing chars, missing question' ELSE '' END AS errors,
    json_merge_patch(
      CASE WHEN r.turn >= 2 THEN json_object('after', '${r-' || r.conv_id || '-' || (r.turn - 2) || '}')
        ELSE json('{}') END,
      json_object('chars', length(r.text), 'question', r.text)) AS arguments, NULL AS last
  FROM reply r LEFT JOIN answer a ON a.conv_id = r.conv_id AND a.turn = r.turn + 1
),
instructs AS (
  SELECT conv_id, turn, 's-' || conv_id || '-' || turn, 'instruct', false, NULL,
    CASE WHEN text IS NULL THEN 'missing text' ELSE '' END,
    json_merge_patch(json('{}'), json_object('text', text)), NULL
  FROM turns WHERE role = 'system'
),
outlines AS (
  SELECT conv_id, turn, 'o-' || conv_id || '-' || turn, 'outline', false, NULL,
    CASE WHEN last IS NULL THEN 'missing last' ELSE '' END,
    json_merge_patch(json('{}'),
      json_object('last', '${r-' || conv_id || '-' || last || '}', 'turns', turns)), last
  FROM chat
),
calls AS (
  SELECT * FROM replies UNION ALL SELECT * FROM instructs UNION ALL SELECT * FROM outlines
)
SELECT conv_id, turn, 0 AS place, call_id, name,
  CASE WHEN answered THEN 'linked' ELSE 'unanswered' END AS status,
  answered::BIGINT AS n_results, errors = '' AS valid, errors,
  CAST(json_merge_patch(json('{}'),
    json_object('arguments', arguments, 'id', call_id, 'name', name, 'result', result)) AS VARCHAR) AS message,
  coalesce(last, turn) AS ready_turn, 0 AS ready_place,
  coalesce('r-' || conv_id || '-' || last, call_id) AS ready_id, (last IS NOT NULL)::INT AS level
FROM calls
UNION ALL
SELECT a.conv_id, a.turn, 0, 'r-' || a.conv_id || '-' || (a.turn - 1), NULL, 'orphan', 1, false,
  'no such call',
  CAST(json_merge_patch(json('{}'), json_object('id', 'r-' || a.conv_id || '-' || (a.turn - 1), 'result', a.text)) AS VARCHAR),
  NULL, NULL, NULL, NULL
FROM answer a WHERE NOT EXISTS (
  SELECT 1 FROM reply r WHERE r.conv_id = a.conv_id AND r.turn = a.turn - 1)
"""

QUERIES = {"op4_chat_tool_calls": op4_chat_tool_calls}
ORACLES = {"op4_chat_tool_calls": ORACLE}
