import json

import duckdb
from compare import difference
from llm_tables import clashing

from clamor.llm.chat_queries import ORACLES, QUERIES
from clamor.llm.tool_calls import link_tool_calls

MESSAGES = "conv_id long, turn long, role string, text string"
PARAMETERS = "name string, parameter string, type string, required boolean"
RULES = [
    ("find", "query", "string", True), ("find", "limit", "integer", False),
    ("add", "x", "number", True), ("add", "tags", "array", False), ("add", "how", "object", False),
    ("add", "sure", "boolean", False), ("add", "none", "null", False), ("now", None, None, None),
]


def call(*calls):
    return json.dumps({"tool_calls": [dict(zip(("id", "name", "arguments"), c, strict=True)) for c in calls]})


def result(call_id, content):
    return json.dumps({"tool_call_id": call_id, "content": content})


def linked(spark, messages, **extra):
    frame = clashing(spark.createDataFrame(messages, MESSAGES), *extra.get("names", ()))
    return link_tool_calls(frame, spark.createDataFrame(RULES, PARAMETERS)).collect()


def test_links_and_canonical_json(spark):
    rows = linked(spark, [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", call(("a", "find", {"query": "x\n\"é", "limit": 3}), ("b", "now", {}))),
        (1, 2, "tool", result("b", {"z": 1, "a": [1.50, None]})),
        (1, 3, "tool", result("a", "plain text")),
        (1, 4, "tool", result("a", "again")),
        (1, 5, "tool", result("ghost", "?")),
        (2, 0, "tool", result("a", "of another chat")),
        (2, 1, "assistant", call(("c", "find", '{"limit": 1, "query": "q"}'))),
    ])
    by_id = {(r.conv_id, r.call_id): r for r in rows}
    assert {k: (r.status, r.n_results) for k, r in by_id.items()} == {
        (1, "a"): ("linked", 2), (1, "b"): ("linked", 1), (1, "ghost"): ("orphan", 1),
        (2, "a"): ("orphan", 1), (2, "c"): ("unanswered", 0),
    }
    assert by_id[1, "a"].message == (
        '{"arguments":{"limit":3,"query":"x\\n\\"é"},"id":"a","name":"find","result":"plain text"}'
    )
    assert by_id[1, "b"].message == (
        '{"arguments":{},"id":"b","name":"now","result":{"a":[1.5,null],"z":1}}'
    )
    assert by_id[2, "c"].valid and by_id[2, "c"].message == (
        '{"arguments":{"limit":1,"query":"q"},"id":"c","name":"find"}'
    )
    assert all(r.level == 0 for r in rows if r.status != "orphan")


CHECKS = [
    ("find", {"query": "q"}, ""),
    ("find", {}, "missing query"),
    ("find", {"query": 1, "limit": "2", "more": 0}, "type of limit, type of query, unknown more"),
    ("find", {"query": "q", "limit": 2.5}, "type of limit"),
    ("add", {"x": 1, "tags": [], "how": {}, "sure": True, "none": None}, ""),
    ("add", {"x": 1e300, "tags": {}, "how": [], "sure": 0, "none": 0},
     "type of how, type of none, type of sure, type of tags"),
    ("add", {"x": None}, "type of x"),
    ("now", {}, ""), ("now", {"x": 1}, "unknown x"),
    ("no", {}, "no such tool"), (None, {}, "no such tool"),
    ("find", [1], "arguments are no object"), ("find", "text", "arguments are no object"),
    ("find", None, "arguments are no object"),
]


def test_arguments_are_checked(spark):
    calls = [(str(k), name, arguments) for k, (name, arguments, _) in enumerate(CHECKS)]
    rows = {int(r.call_id): r for r in linked(spark, [(1, 0, "assistant", call(*calls))])}
    for k, (_, _, errors) in enumerate(CHECKS):
        assert (rows[k].errors, rows[k].valid) == (errors, errors == "")


def circular(deps):
    done = set()
    while True:
        ready = {c for c in deps if c not in done and all(d in done or d not in deps for d in deps[c])}
        if not ready:
            return len(done) < len(deps)
        done |= ready


def latest(deps, call):
    """The latest of a call and of all that it waits for."""
    return max([call, *[latest(deps, d) for d in deps[call] if d in deps]])


CHATS = [
    {0: [], 1: [0], 2: [1], 3: [0, 2]},
    {0: [3], 1: [0], 2: [], 3: [2]},
    {0: [1], 1: [0], 2: [1], 3: [4], 4: []},
    {0: [0], 1: []},
    {0: [9], 1: [2, 9], 2: []},
    {0: [2, 4], 1: [0], 2: [1], 3: [], 4: []},
    {0: [5], 1: [0, 3], 2: [1], 3: [], 4: [2], 5: [3]},
    {k: [k + 1] for k in range(6)} | {6: []},
]


def test_order_is_topological(spark):
    messages = []
    for chat, deps in enumerate(CHATS):
        text = {c: {"query": " ".join("${%d}" % d for d in needs)} for c, needs in deps.items()}
        messages += [(chat, c, "assistant", call((str(c), "find", a))) for c, a in text.items()]
    found = linked(spark, messages)
    for chat, deps in enumerate(CHATS):
        rows = [r for r in found if r.conv_id == chat]
        assert len(rows) == len(deps)
        if circular(deps):
            assert {(r.ready_turn, r.ready_id, r.level) for r in rows} == {(None, None, None)}
            continue
        rows.sort(key=lambda r: (r.ready_turn, r.ready_place, r.ready_id, r.level, r.turn, r.place))
        place = {int(r.call_id): k for k, r in enumerate(rows)}
        assert all(place[d] < place[c] for c, needs in deps.items() for d in needs if d in deps)
        for r in rows:
            assert r.ready_turn == latest(deps, r.turn)
            assert (r.level == 0) == (r.ready_turn == r.turn)


def test_long_chat_in_order_needs_no_rounds(spark):
    messages = [
        (1, k, "assistant", call((f"c{k}", "find", {"query": "${c%d}" % (k - 1)}))) for k in range(300)
    ]
    messages.append((1, -1, "assistant", call(("o", "find", {"query": "${c299}"}))))
    rows = {r.call_id: r for r in linked(spark, messages)}
    assert (rows["o"].ready_turn, rows["o"].level) == (299, 1)
    assert all((r.ready_turn, r.level) == (r.turn, 0) for k, r in rows.items() if k != "o")


def test_odd_rows_and_empty_table(spark):
    good = call(("a", "now", {}))
    rows = linked(spark, [
        (None, None, None, None), (1, 0, "assistant", None), (1, 1, "assistant", ""),
        (1, 2, "assistant", "{broken"), (1, 3, "assistant", '{"tool_calls": 5}'),
        (1, 4, "assistant", '{"a": 1, "a": 2}'), (1, 5, "tool", "{}"), (1, 6, "tool", "x" * 50_000),
        (None, 7, "assistant", good), (None, 8, "tool", result("a", None)),
        (1, 9, "assistant", good), (1, 9, "assistant", good), (1, 10, "user", good),
        (1, 11, "assistant", '{"tool_calls": [{"name": "now"}, 4]}'),
        (2, 0, "assistant", call(("big", "find", {"query": "q " * 40_000}))),
    ], names=("name", "level", "chat"))
    assert sorted((str(r.conv_id), r.turn, str(r.call_id), r.status) for r in rows) == [
        ("1", 9, "a", "unanswered"), ("1", 9, "a", "unanswered"), ("1", 11, "None", "unanswered"),
        ("1", 11, "None", "unanswered"), ("2", 0, "big", "unanswered"), ("None", 7, "a", "linked"),
    ]
    empty = spark.createDataFrame([], MESSAGES)
    assert link_tool_calls(empty, spark.createDataFrame(RULES, PARAMETERS)).count() == 0


def test_results_without_an_id_are_orphans(spark):
    rows = linked(spark, [
        (1, 0, "tool", '{"content": "x"}'), (1, 0, "tool", '{"content": "x"}'),
        (1, 1, "tool", '{"tool_call_id": null, "content": {"b": 1}}'), (None, 2, "tool", '{"tool_call_id": null}'),
        (1, 3, "tool", "{}"), (1, 4, "assistant", call((None, "now", {}))),
    ])
    assert sorted((str(r.conv_id), r.turn, r.call_id, r.status, r.n_results, r.message) for r in rows) == [
        ("1", 0, None, "orphan", 1, '{"result":"x"}'), ("1", 0, None, "orphan", 1, '{"result":"x"}'),
        ("1", 1, None, "orphan", 1, '{"result":{"b":1}}'),
        ("1", 4, None, "unanswered", 0, '{"arguments":{},"name":"now"}'),
        ("None", 2, None, "orphan", 1, "{}"),
    ]


def test_query_on_nulls(spark, tmp_path):
    turns = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, None, "assistant", "c"), (1, None, "user", "d"),
        (1, 2, None, "e"), (1, 3, "critic", "f"), (2, 0, "assistant", None), (2, None, "assistant", None),
        (None, 0, "system", "g"), (None, 1, "assistant", "h"), (None, 1, "assistant", "h"),
        (None, None, "assistant", None), (None, 2, None, "i"), (3, 0, None, "j"),
    ]
    spark.createDataFrame(turns, MESSAGES).coalesce(1).write.parquet(str(tmp_path / "out"))
    next((tmp_path / "out").glob("*.parquet")).rename(tmp_path / "conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet')")
    key = "op4_chat_tool_calls"
    assert difference(spark, con, str(tmp_path), QUERIES[key], ORACLES[key]) == ""


def test_calls_and_results_meet_in_hash_joins(spark):
    frame = spark.createDataFrame([(1, 0, "assistant", call(("a", "now", {})))], MESSAGES)
    plan = link_tool_calls(frame, spark.createDataFrame(RULES, PARAMETERS))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ShuffledHashJoin") == 3
