import base64
import collections
import hashlib

import pytest

from stratum.llm import warc

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    same = collections.defaultdict(list)
    for p, _, h in rows:
        same[h or ""].append(p)
    out = []
    for p, _, h in rows:
        body = (h or "").encode()
        top = max((x for x in same[h or ""] if x is not None), default=None)
        again = p is not None and p < top
        out.append((p, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


BIG = "x" * 50
EMBEDDED = f"tail WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 20\r\n\r\n{BIG}\r\n\r\nWARC/1.0\r\n"
ROWS = [
    (1, "http://a", None), (2, "u", ""), (3, None, "héllo"), (4, "a\r\nb: c", "héllo"), (5, "u", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (6, "u", "pre WARC/1.0\r\nWARC/1.0\r\nnope"), (7, "u", EMBEDDED), (8, "u", "same"), (8, "u", "same"), (9, "u", "\r\n\r\n\r\n"), (None, "u", "q"),
    (10, "u", "q"), (11, "u", "WARC/1.0\r\n"), (12, "u", "WARC/1.0"), (13, "u", "\r\nWARC"), (14, "u", "long " * 20_000),
    (15, "http://b\u2028Content-Length: 0", "after LS"), (16, "http://b\u0085Content-Length: 0\x0bWARC-Type: revisit", "after NEL"), (17, "u\u2029WARC-Record-ID: <urn:page:3>", "after PS"),
    (18, "\x00\t\x7f é", "controls"),
] + [(100 + i, "u", f"doc {i} WARC/1.0\r\n\r\n\r\n" + "é" * i) for i in range(30)]


@pytest.mark.parametrize("split", ["300", "128m"])
def test_round_trip_with_magic_in_payloads_and_any_split(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.round_trip(spark.createDataFrame(ROWS if split != "300" else [r for r in ROWS if r[0] != 14], SCHEMA).repartition(2))
        rows = ROWS if split != "300" else [r for r in ROWS if r[0] != 14]
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_smaller_payloads_stay_responses(spark):
    from stratum.session import shared_dir

    path = shared_dir(spark, "warc-test", unique=True)
    warc.write(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA), path, least_bytes=3)
    assert sorted(r["type"] for r in warc.read(spark, path).collect()) == ["response"] * 3 + ["revisit"]


def test_unsafe_characters_of_urls_are_encoded(spark):
    from stratum.session import shared_dir

    path = shared_dir(spark, "warc-test", unique=True)
    warc.write(spark.createDataFrame([(1, "http://b\u2028x\u0085\r\n é%20", "a"), (2, "http://plain/é?q=1 2", "b")], SCHEMA), path)
    assert sorted(r["uri"] for r in warc.read(spark, path).collect()) == ["http://b%E2%80%A8x%C2%85%0D%0A é%20", "http://plain/é?q=1 2"]


def test_a_chain_that_stops_early_is_an_error(spark):
    import tempfile

    folder = tempfile.mkdtemp(prefix="stratum-warc-")
    record = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: {}\r\n\r\nabc\r\n\r\n"
    for name, second in (("good", 3), ("bad", "x")):
        with open(f"{folder}/{name}", "w", newline="") as fh:
            fh.write(record.format(3) + record.format(second))
    assert warc.read(spark, f"{folder}/good").count() == 2
    with pytest.raises(ValueError, match="bad"):
        warc.read(spark, folder)
    assert warc.read(spark, folder, whole_files=False).count() == 3
    clash = spark.createDataFrame([(1, "u", "abc", 5, "x", 7)], SCHEMA + ", digest int, bytes string, first int")
    assert warc.round_trip(clash).count() == 1
