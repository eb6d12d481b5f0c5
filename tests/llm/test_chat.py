import json

from stratum.llm import chat

CALL = "conv_id long, call_id string, place long, name string, arguments string, needs array<string>"
RESULT = "conv_id long, call_id string, place long, content string"
MESSAGE = "conv_id long, place long, role string, text string"


def lines(spark, messages, calls, results):
    rows = chat.conversation_lines(spark.createDataFrame(messages, MESSAGE), spark.createDataFrame(calls, CALL), spark.createDataFrame(results, RESULT)).collect()
    return sorted(rows, key=lambda r: (r["conv_id"] if r["conv_id"] is not None else -1, r["seq"]))


def test_links_and_order(spark):
    calls = [(1, "a", 5, "search", '{"query":"x"}', None), (1, "b", 2, "search", '{"query":"y"}', ["a"]), (1, "c", 3, "search", '{"query":"z"}', ["b", "nope", None]),
             (2, "a", 0, "search", '{"query":"x"}', [])]
    results = [(1, "a", 1, "ra"), (1, "b", 9, "rb"), (1, "b", 9, "rb2"), (1, "zz", 4, "stray"), (2, None, 1, "lost")]
    out = lines(spark, [(1, 0, "system", "hi"), (2, None, None, None)], calls, results)
    first = [(r["kind"], r["call_id"], r["linked"]) for r in out if r["conv_id"] == 1]
    place = {(k, c, x): i for i, (k, c, x) in enumerate(first)}
    assert first[0][0] == "message" and len(first) == 8
    assert place["call", "a", True] < place["result", "a", True] < place["call", "b", True] < place["result", "b", True] < place["call", "c", False]
    assert ("result", "zz", False) in first and ("result", "b", False) in first
    assert [r["seq"] for r in out if r["conv_id"] == 1] == list(range(8))
    assert [r["linked"] for r in out if r["conv_id"] == 2 and r["kind"] == "result"] == [False]


def test_brute_force_order_on_random_needs(spark):
    import random

    r, calls, results = random.Random(3), [], []
    for conv in range(25):
        ids = [f"c{i}" for i in range(8)]
        for i, c in enumerate(ids):
            needs = r.sample(ids[:i], min(i, r.choice([0, 1, 2])))
            calls.append((conv, c, r.randrange(20), "search", "{}", needs))
            results.append((conv, c, r.randrange(20), f"r{i}"))
    out = lines(spark, [], calls, results)
    at = {(x["conv_id"], x["kind"], x["call_id"]): x["seq"] for x in out}
    for conv, c, _, _, _, needs in calls:
        assert at[conv, "call", c] < at[conv, "result", c]
        assert all(at[conv, "result", n] < at[conv, "call", c] for n in needs)


def test_cycles_end(spark):
    calls = [(1, "a", 1, "search", "{}", ["b"]), (1, "b", 2, "search", "{}", ["a"]), (1, "c", 0, "search", "{}", ["c"])]
    tied = chat.order(chat.link(spark.createDataFrame(calls, CALL), spark.createDataFrame([], RESULT)))
    assert {r["call_id"] for r in tied.collect() if r["cyclic"]} == {"a", "b", "c"}


def test_validation_and_canonical_json(spark):
    cases = [("search", '{"query":"q"}', True), ("search", '{"limit":3,"query":"q"}', True), ("search", '{"limit":"3","query":"q"}', False),
             ("search", '{"limit":3}', False), ("search", '{"query":null}', False), ("search", '{"query":"q","more":1}', False), ("search", "[1]", False),
             ("search", "no json", False), ("search", None, False), ("search", '{"query":"a","query":"b"}', False), ("other", "{}", False), (None, "{}", False),
             ("note", '{"text":"t","turn":1,"pinned":true}', True), ("note", '{"text":"t","turn":1.5}', False)]
    calls = [(1, f"c{i:02}", i, n, a, None) for i, (n, a, _) in enumerate(cases)]
    out = lines(spark, [], calls, [])
    assert [r["valid"] for r in out] == [v for _, _, v in cases]
    for r, (name, a, _) in zip(out, cases, strict=True):
        got = json.loads(r["json"])
        try:
            want = json.loads(a or "", object_pairs_hook=lambda p: dict(p) if len(dict(p)) == len(p) else [][0])
        except (ValueError, IndexError):
            want = [a] if a is not None else [None]
        assert got.get("name") == name and (got["arguments"] == want or a is None)
    from pyspark.sql import functions as F
    text = spark.createDataFrame([('{"b": 1.50,\n "a": {"z": [1, {"y":"\\u00e9"}], "k": true}}',)], "j string").select(chat.canonical(F.col("j"))).first()[0]
    assert text == '{"a":{"k":true,"z":[1,{"y":"é"}]},"b":1.5}'


def test_many_places_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(chat, "PLACES", 7)
    out = lines(spark, [(1, i // 2, "user", str(i)) for i in range(100)] + [(None, None, "user", "x")] * 2, [], [])
    assert [r["seq"] for r in out if r["conv_id"] == 1] == list(range(100))
    assert [r["seq"] for r in out if r["conv_id"] is None] == [0, 1]


def test_events_of_plain_turns(spark):
    schema = "conv_id long, turn long, role string, text string, place long, name string"
    turns = [(20, 0, "user", "q", 1, "x"), (20, 1, "assistant", "a", 1, "x"), (20, 2, "user", None, 1, "x"), (3, 0, "system", "s", 1, "x"), (3, None, None, "t", 1, "x"),
             (None, 0, "user", "n", 1, "x")]
    out = chat.conversation_lines(*chat.tool_events(spark.createDataFrame(turns, schema))).collect()
    assert len(out) == len(turns)
    linked = {(r["conv_id"], r["kind"], r["call_id"]): r for r in out}
    assert linked[20, "call", "call_20_0"]["linked"] and linked[20, "call", "call_20_0"]["seq"] == 0 and linked[20, "result", "call_20_0"]["seq"] == 1
    assert chat.conversation_lines(*chat.tool_events(spark.createDataFrame([], schema))).count() == 0


def test_native_plan(spark, sf_dir):
    plan = chat.conversation_lines(*chat.tool_events(spark.read.parquet(f"{sf_dir}/conversations.parquet")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
