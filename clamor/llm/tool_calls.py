"""Chat formatting: tool calls linked to their results, ordered, checked, serialised.

An assistant message may be a JSON object with ``tool_calls``: a list of objects with
``id``, ``name`` and ``arguments`` (an object, or a JSON text of one).  A message of
role ``tool`` is a JSON object with ``tool_call_id`` and ``content``.  Calls and results
of a chat are joined by their id.

A call depends on those whose id its arguments name as ``${id}``.  It is ready at its
own position, or at the latest position of a call that it waits for, directly or not,
if that one comes later; then its level counts the calls between.  Chats are sorted
topologically by where calls are ready, then by level.  Only what stands before a call
that it needs has to wait: there are as many rounds as calls in a row that are out of
order (in a circle: as calls of that chat, at most), whatever the length of chats in
order.  A chat whose calls wait for each other in a circle has no order: all its calls
have none of the four.

Arguments are checked against a table of parameters (name, parameter, type, required);
a tool without parameters takes none, its one row has a null parameter.  Types are
those of JSON: string, integer, number, boolean, null, array, object.  The message is
canonical JSON: keys sorted, no white space, numbers and texts in one form.

Messages that are null, empty or other text hold no calls.  A call without id links to
nothing.  Of several results of one call the first by turn (then by text) is used and
all are counted; calls that share an id share their results.  Results without a call
are rows of their own, and of those without an id each is one.  An object that has
neither an id nor content is no result.  A null conv_id is a chat as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clamor.llm.common import materialise

# Type names of variants by the JSON type that they stand for.
INTEGERS = r"^(BIGINT|DECIMAL\(\d+,0\))$"
NUMBERS = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"

REFERENCE = r"\$\{([^}\"]+)\}"


def chat_of(conv_id: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("c"), conv_id.cast("string")), F.lit("-"))


def _object(text: Column) -> Column:
    return F.when(F.startswith(F.ltrim(text), F.lit("{")), F.try_parse_json(text))


def tool_calls(messages: DataFrame) -> DataFrame:
    """conv_id, chat, turn, place, call_id, name, arguments (variant) of every call."""
    parsed = messages.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", _object(F.col("text")).alias("body")
    )
    each = parsed.select(
        "conv_id", "turn",
        F.posexplode(F.try_variant_get("body", "$.tool_calls", "array<variant>")).alias("place", "call"),
    )
    given = F.try_variant_get("call", "$.arguments", "variant")
    as_text = F.try_variant_get("call", "$.arguments", "string")
    parsed_text = F.when(F.schema_of_variant(given) == "STRING", F.try_parse_json(as_text))
    return each.select(
        "conv_id",
        chat_of(F.col("conv_id")).alias("chat"),
        "turn",
        "place",
        F.try_variant_get("call", "$.id", "string").alias("call_id"),
        F.try_variant_get("call", "$.name", "string").alias("name"),
        F.coalesce(parsed_text, given).alias("arguments"),
    )


def tool_results(messages: DataFrame) -> DataFrame:
    """conv_id, chat, turn, call_id, content (text) of every result."""
    body = _object(F.col("text"))
    said = [F.try_variant_get("body", f"$.{key}", "variant").isNotNull() for key in ("tool_call_id", "content")]
    return (
        messages.filter(F.col("role") == "tool")
        .select("conv_id", "turn", body.alias("body"))
        .filter(said[0] | said[1])
        .select(
            "conv_id",
            chat_of(F.col("conv_id")).alias("chat"),
            "turn",
            F.try_variant_get("body", "$.tool_call_id", "string").alias("call_id"),
            F.coalesce(
                F.try_variant_get("body", "$.content", "string"),
                F.to_json(F.try_variant_get("body", "$.content", "variant")),
            ).alias("content"),
        )
    )


def _state(turn: str, place: str, call_id: str, level: Column) -> Column:
    return F.struct(
        F.col(turn).alias("turn"), F.col(place).alias("place"), F.col(call_id).alias("id"),
        level.cast("int").alias("level"),
    )


def ready_states(calls: DataFrame) -> DataFrame:
    """chat, call_id, ready (turn, place, id, level) of the calls in chats that are not in
    order as they stand; ready is null in chats with a circle."""
    node = ["chat", "call_id"]
    named = calls.filter(F.col("call_id").isNotNull())
    first = F.min(F.struct("turn", "place")).alias("at")
    nodes = named.groupBy(*node).agg(first).select(*node, "at.turn", "at.place")
    own = _state("turn", "place", "call_id", F.lit(0)).alias("own")
    nodes = materialise(nodes.select(*node, own))
    references = F.regexp_extract_all(F.to_json("arguments"), F.lit(REFERENCE), F.lit(1))
    needed = nodes.select("chat", F.col("call_id").alias("needs"), F.col("own").alias("needs_own"))
    edges = (
        named.select(*node, F.explode(F.array_distinct(references)).alias("needs"))
        .distinct()
        .join(nodes, node)
        .join(needed, ["chat", "needs"])
    )
    late = edges.filter(F.col("needs_own") >= F.col("own")).select("chat").distinct()
    late = materialise(late)
    sizes = nodes.join(late, "chat", "left_semi").groupBy("chat").agg(F.count("*").alias("size"))
    edges = materialise(
        edges.select("chat", "call_id", "needs", "own").join(sizes, "chat")
    )
    state = materialise(
        nodes.join(late, "chat", "left_semi").select(*node, "own", F.col("own").alias("ready"))
    )
    circles = []
    while True:
        before = state.select("chat", F.col("call_id").alias("needs"), F.col("ready").alias("r"))
        waits = materialise(edges.join(before, ["chat", "needs"]).select(*node, "own", "size", "r"))
        # A circle: a call that waits for one that waits for it, or more calls in a row
        # than there are.
        round_it = (F.col("r.id") == F.col("own.id")) | (F.col("r.level") + 1 >= F.col("size"))
        closed = materialise(waits.filter(round_it).select("chat").distinct())
        circles.append(closed)
        latest = waits.groupBy(*node).agg(F.max("r").alias("r"))
        after = _state("r.turn", "r.place", "r.id", F.col("r.level") + 1)
        state = materialise(
            state.join(latest, node, "left")
            .join(closed, "chat", "left_anti")
            .withColumn("new", F.greatest("ready", F.when(F.col("r").isNotNull(), after)))
            .select(*node, "own", F.col("new").alias("ready"), (F.col("new") != F.col("ready")).alias("moved"))
        )
        if state.filter("moved").isEmpty():
            break
        state = state.drop("moved")
    circular = nodes.join(reduce(DataFrame.unionAll, circles).distinct(), "chat", "left_semi")
    nothing = F.lit(None).cast(state.schema["ready"].dataType)
    return state.select(*node, "ready").unionAll(circular.select(*node, nothing))


def schema_rows(parameters: DataFrame) -> DataFrame:
    """name and a map of parameter to its type and whether it is required."""
    entry = F.struct(
        F.col("parameter"), F.struct(F.col("type"), F.col("required")).alias("rule")
    )
    return parameters.groupBy(F.col("name").alias("tool")).agg(
        F.map_from_entries(
            F.array_sort(F.collect_set(F.when(F.col("parameter").isNotNull(), entry)))
        ).alias("rules")
    )


def _fits(given: Column, wanted: Column) -> Column:
    return (
        F.when(wanted == "integer", given.rlike(INTEGERS))
        .when(wanted == "number", given.rlike(NUMBERS))
        .when(wanted == "array", given.startswith("ARRAY"))
        .when(wanted == "object", given.startswith("OBJECT"))
        .when(wanted == "null", given == "VOID")
        .otherwise(given == F.upper(wanted))
    )


def argument_errors(arguments: Column, rules: Column) -> Column:
    """Sorted errors; empty where the arguments fit."""
    kinds = F.transform_values(
        F.coalesce(arguments, F.create_map().cast("map<string,variant>")),
        lambda _, v: F.schema_of_variant(v),
    )
    absent = F.transform(
        F.filter(
            F.map_keys(rules),
            lambda p: F.element_at(rules, p)["required"] & ~F.map_contains_key(kinds, p),
        ),
        lambda p: F.concat(F.lit("missing "), p),
    )
    unknown = F.transform(
        F.filter(F.map_keys(kinds), lambda p: ~F.map_contains_key(rules, p)),
        lambda p: F.concat(F.lit("unknown "), p),
    )
    unfit = F.transform(
        F.filter(
            F.map_keys(kinds),
            lambda p: F.map_contains_key(rules, p)
            & ~_fits(F.element_at(kinds, p), F.element_at(rules, p)["type"]),
        ),
        lambda p: F.concat(F.lit("type of "), p),
    )
    return (
        F.when(rules.isNull(), F.array(F.lit("no such tool")))
        .when(arguments.isNull(), F.array(F.lit("arguments are no object")))
        .otherwise(F.array_sort(F.concat(absent, unknown, unfit)))
    )


def link_tool_calls(messages: DataFrame, parameters: DataFrame) -> DataFrame:
    """conv_id, turn, place, call_id, name, status, n_results, valid, errors, message
    (canonical JSON), ready_turn, ready_place, ready_id and level of every call, and of
    every result without one.

    messages: conv_id, turn, role, text; parameters: name, parameter, type, required.
    status is linked, unanswered or orphan (a result without a call).
    """
    calls = materialise(
        tool_calls(messages).withColumn("arguments", F.to_json("arguments"))
    ).withColumn("arguments", F.try_parse_json("arguments"))
    node = ["chat", "call_id"]
    results = materialise(
        tool_results(messages)
        .filter(F.col("call_id").isNotNull())
        .groupBy(*node)
        .agg(
            F.count("*").alias("n_results"),
            F.min(F.struct("turn", "content")).alias("first"),
            F.first("conv_id").alias("result_conv"),
        )
    )
    waiting = ready_states(calls).withColumn("late", F.lit(True))
    linked = (
        # Both sides are spread by call, whose rows are few: results and states are hashed.
        calls.join(results.hint("shuffle_hash"), node, "left")
        .join(waiting.hint("shuffle_hash"), node, "left")
        .join(schema_rows(parameters), F.col("name") == F.col("tool"), "left")
        .withColumn("given", F.expr("try_cast(arguments AS map<string, variant>)"))
    )
    result = F.coalesce(F.try_parse_json("first.content"), F.expr("CAST(first.content AS variant)"))
    errors = argument_errors(F.col("given"), F.col("rules"))
    answered = linked.select(
        "conv_id", "turn", "place", "call_id", "name",
        F.when(F.col("n_results") > 0, "linked").otherwise("unanswered").alias("status"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.when(F.col("late"), F.col("ready"))
        .otherwise(_state("turn", "place", "call_id", F.lit(0)))
        .alias("ready"),
        errors.alias("errors"),
        F.to_json(
            F.struct(
                "arguments", F.col("call_id").alias("id"), "name", result.alias("result")
            )
        ).alias("message"),
    )
    nameless = (
        tool_results(messages)
        .filter(F.col("call_id").isNull())
        .select(
            *node, F.lit(1).cast("long").alias("n_results"),
            F.struct("turn", "content").alias("first"), F.col("conv_id").alias("result_conv"),
        )
    )
    called = calls.select(*node).distinct().hint("shuffle_hash")
    uncalled = results.join(called, node, "left_anti").unionByName(nameless)
    orphans = uncalled.select(
        F.col("result_conv").alias("conv_id"), F.col("first.turn").alias("turn"),
        F.lit(0).alias("place"), "call_id", F.lit(None).cast("string").alias("name"),
        F.lit("orphan").alias("status"), F.col("n_results").cast("long"),
        F.lit(None).cast(answered.schema["ready"].dataType).alias("ready"),
        F.array(F.lit("no such call")).alias("errors"),
        F.to_json(F.struct(F.col("call_id").alias("id"), result.alias("result"))).alias("message"),
    )
    return answered.unionAll(orphans).withColumn("valid", F.size("errors") == 0).select(
        "conv_id", "turn", "place", "call_id", "name", "status", "n_results", "valid",
        F.array_join("errors", ", ").alias("errors"), "message",
        F.col("ready.turn").alias("ready_turn"), F.col("ready.place").alias("ready_place"),
        F.col("ready.id").alias("ready_id"), F.col("ready.level").alias("level"),
    )
