"""Chat formatting with linked tool calls [DataFrame functions only].

Calls and results are hash-joined by conversation and identifier, ordered so
that a call follows the calls it depends on and a result its call, validated
against the tools' schemas and serialised as canonical JSON, a line a message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Places that one task numbers of a conversation, at most about.
PLACES = 10_000

#: Tools by name: argument, type (string, integer, number, boolean, array, object), required.
SCHEMAS = {
    "search": (("limit", "integer", False), ("query", "string", True)),
    "translate": (("text", "string", True), ("to", "string", True)),
    "note": (("pinned", "boolean", False), ("text", "string", True), ("turn", "integer", True)),
}

_TYPES = {"string": "STRING", "integer": "BIGINT", "number": r"BIGINT|DOUBLE|DECIMAL\(.*\)", "boolean": "BOOLEAN", "array": "ARRAY<.*>", "object": "OBJECT<.*>"}


def canonical(json: Column) -> Column:
    """Keys in order, no white space, one spelling of every string and number;
    null for text that is no JSON or has a key twice."""
    return F.to_json(F.try_parse_json(json))


def valid_arguments(name: Column, arguments: Column, schemas: dict | None = None) -> Column:
    """Whether the arguments are a JSON object with the tool's required keys,
    no others than its own, and values of its types; unknown tools: false."""
    parsed, keys = F.try_parse_json(arguments), F.json_object_keys(arguments)
    out = F.lit(False)
    for tool, fields in (SCHEMAS if schemas is None else schemas).items():
        good = keys.isNotNull() & (F.size(F.array_except(keys, F.array(*(F.lit(f) for f, _, _ in fields)) if fields else F.array().cast("array<string>"))) == 0)
        for field, kind, required in fields:
            value = F.variant_get(parsed, f"$['{field}']", "variant")
            there = F.coalesce(F.array_contains(keys, field), F.lit(False))
            fits = F.coalesce(F.schema_of_variant(value).rlike(f"^({_TYPES[kind]})$"), F.lit(False))
            good = good & (fits if required else ~there | fits)
        out = F.when(name == tool, F.coalesce(good & parsed.isNotNull(), F.lit(False))).otherwise(out)
    return F.coalesce(out, F.lit(False))


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """``calls`` (conv_id, call_id, place, name, arguments, needs) with their
    result: result, result_place and n_results.  The result that counts is the
    first by place, then by content.  Null identifiers link with nothing."""
    first = results.filter("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("place", "content")).alias("_first"), F.count("*").alias("n_results"))
    return calls.join(first, ["conv_id", "call_id"], "left").select(
        *calls.columns, F.col("_first.content").alias("result"), F.col("_first.place").alias("result_place"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"))


def order(linked: DataFrame) -> DataFrame:
    """``linked`` with the keys (place, level) ``at`` of the call and ``done``
    of its result, such that sorting by them is a topological order, and
    ``cyclic``.

    Places are kept where they are in order already: one join then finds
    nothing to mend.  A call before what it needs moves to just after it
    (its place, one level up), and so on along the needs until nothing moves.
    Calls that need each other would move forever; a level beyond the moved
    calls of the conversation shows that, and they stay as ``cyclic``."""
    key = lambda p, n: F.struct(p.cast("long").alias("place"), n.cast("long").alias("level"))
    after = lambda k: F.struct(k["place"].alias("place"), (k["level"] + 1).alias("level"))
    settle = lambda at, own: F.when(own.isNotNull(), F.greatest(own, after(at)))
    at = key(F.col("place"), F.lit(0))
    own = F.when(F.col("result_place").isNotNull(), key(F.col("result_place"), F.lit(0)))
    state = saved(linked.withColumn("at", at).withColumn("done", settle(at, own)).withColumn("moved", F.lit(False)).withColumn("cyclic", F.lit(False)), "chat-order")
    needs = saved(linked.select("conv_id", "call_id", F.explode("needs").alias("need")).filter("need is not null").distinct(), "chat-needs")
    while True:
        done = state.filter("call_id is not null").select("conv_id", F.col("call_id").alias("need"), F.greatest("at", F.coalesce("done", "at")).alias("end"))
        least = needs.join(done, ["conv_id", "need"]).groupBy("conv_id", "call_id").agg(F.max("end").alias("end"))
        late = state.join(least, ["conv_id", "call_id"], "left").withColumn("_late", F.coalesce(F.col("end") >= F.col("at"), F.lit(False)) & ~F.col("cyclic"))
        if not late.filter("_late").limit(1).count():
            return state.drop("moved")
        bound = late.groupBy("conv_id").agg(F.count_if(F.col("moved") | F.col("_late")).alias("_most")).withColumnRenamed("conv_id", "_conv")
        new = F.when(F.col("_late"), after(F.col("end"))).otherwise(F.col("at"))
        late = late.join(bound, F.col("conv_id") == F.col("_conv"), "left").withColumn("_new", new)
        late = late.withColumn("cyclic", F.col("cyclic") | (F.col("_late") & (F.col("_new.level") > 2 * F.col("_most") + 1)))
        state = saved(late.select(*linked.columns, F.col("_new").alias("at"), settle(F.col("_new"), F.col("done")).alias("done"),
                                  (F.col("moved") | F.col("_late")).alias("moved"), "cyclic"), "chat-order")


def _numbered(lines: DataFrame) -> DataFrame:
    """``lines`` with ``seq``, gapless from 0 in a conversation by ``key`` and
    then kind, id and content.  Stretches of places are numbered by themselves,
    so one long conversation is many tasks' work."""
    from pyspark.sql import Window

    lines = lines.withColumn("_part", F.floor(F.col("key.place") / PLACES))
    before = Window.partitionBy("conv_id").orderBy(F.col("_part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    start = lines.groupBy("conv_id", "_part").agg(F.count("*").alias("_n")).select(
        F.col("conv_id").alias("_c"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("conv_id", "_part").orderBy(F.col("key").asc_nulls_first(), "kind", "call_id", "json")
    rows = lines.withColumn("_row", F.row_number().over(inside))
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("_part").eqNullSafe(F.col("_p"))
    return rows.join(start, on).withColumn("seq", (F.col("_start") + F.col("_row") - 1).cast("long"))


def conversation_lines(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: dict | None = None) -> DataFrame:
    """conv_id, seq, kind, call_id, valid, linked, json: a row per message,
    call and result.

    messages: (conv_id, place, role, text); calls and results: see ``link``.
    valid: of calls only, see ``valid_arguments``.  linked: the call has a
    result, or the result is its call's (further results of an id, and those
    without a call, are not and stay at their own place).  json: canonical;
    arguments that are no JSON are kept as a string.  Null places come first,
    null conversations are one conversation; repeated rows are lines of their
    own, but calls that repeat an id share its result and move together.
    Empty tables give no lines."""
    tied = order(link(calls, results))
    body = F.coalesce(F.try_parse_json("arguments"), F.try_parse_json(F.to_json(F.array("arguments"))))
    call = F.to_json(F.struct(body.alias("arguments"), F.col("call_id").alias("id"), "name", F.lit("assistant").alias("role")))
    made = tied.select("conv_id", F.col("at").alias("key"), F.lit("call").alias("kind"), "call_id",
                       valid_arguments(F.col("name"), F.col("arguments"), schemas).alias("valid"), (F.col("n_results") > 0).alias("linked"), call.alias("json"))
    ends = tied.filter("call_id is not null and conv_id is not null").groupBy("conv_id", "call_id").agg(
        F.max("done").alias("done"), F.min(F.struct(F.col("result_place").alias("place"), F.col("result").alias("content"))).alias("first"))
    got = results.select("conv_id", "call_id", "place", "content").join(ends, ["conv_id", "call_id"], "left").withColumn(
        "linked", F.coalesce(F.struct("place", "content").eqNullSafe(F.col("first")), F.lit(False)))
    own = F.struct(F.col("place").cast("long").alias("place"), F.lit(0).cast("long").alias("level"))
    got = got.select("conv_id", F.when(F.col("linked"), F.col("done")).otherwise(own).alias("key"), F.lit("result").alias("kind"), "call_id",
                     F.lit(None).cast("boolean").alias("valid"), "linked",
                     F.to_json(F.struct("content", F.col("call_id").alias("id"), F.lit("tool").alias("role"))).alias("json"))
    said = messages.select("conv_id", own.alias("key"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
                           F.lit(None).cast("boolean").alias("valid"), F.lit(False).alias("linked"),
                           F.to_json(F.struct(F.col("text").alias("content"), "role")).alias("json"))
    lines = saved(made.union(got).union(said), "chat-lines")
    return _numbered(lines).select("conv_id", "seq", "kind", "call_id", "valid", "linked", "json")


def tool_events(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages, calls, results) of a table of plain turns, which has no tool
    turns of its own: a user turn calls a tool with its text, the next turn, if
    the assistant's, is the result, and a call needs the one two turns before.
    Every tenth conversation has neighbouring turns in the wrong order; one
    call in seven has faulty arguments."""
    turn = F.col("turn").cast("long")
    ident = lambda t: F.concat_ws("_", F.lit("call"), F.col("conv_id").cast("string"), t.cast("string"))
    place = F.when(F.col("conv_id") % 10 == 0, turn.bitwiseXOR(F.lit(1).cast("long"))).otherwise(turn)
    rows = conversations.select("conv_id", "role", "text", turn.alias("turn"), place.alias("place"))
    tool = F.element_at(F.array(*(F.lit(t) for t in SCHEMAS)), (F.pmod(F.coalesce("turn", F.lit(0)) + F.coalesce("conv_id", F.lit(0)), F.lit(len(SCHEMAS))) + 1).cast("int"))
    calls = rows.filter("role = 'user'").withColumn("name", tool)
    faulty = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(7)) == 3
    good = F.when(F.col("name") == "search", F.to_json(F.struct(F.col("text").alias("query"), F.lit(10).alias("limit")))).when(
        F.col("name") == "translate", F.to_json(F.struct(F.lit("en").alias("to"), "text"))).otherwise(
        F.to_json(F.struct("turn", "text", (F.col("turn") % 2 == 0).alias("pinned"))))
    calls = calls.select("conv_id", ident(F.col("turn")).alias("call_id"), "place", "name",
                         F.when(faulty, F.to_json(F.struct(F.col("turn").alias("text")))).otherwise(good).alias("arguments"),
                         F.array(ident(F.col("turn") - 2)).alias("needs"))
    results = rows.filter("role = 'assistant'").select("conv_id", ident(F.col("turn") - 1).alias("call_id"), "place", F.col("text").alias("content"))
    messages = rows.filter("role is null or role not in ('user', 'assistant')").select("conv_id", "place", "role", "text")
    return messages, calls, results
