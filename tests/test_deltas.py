"""Layers kept up to date by changes equal a full rebuild."""
import datetime as dt
import random

import pytest
from helpers import bronze
from pyspark.sql import functions as F

from stratum.operators import conform, dims, facts, quality
from stratum.plans import deltas, queries
from stratum.sources import layers

DAY = "2024-01-01 00:00:00"


def rows(df):
    return sorted(map(str, df.collect()))


def outlet(i, link, ok=True, **more):
    return {"id_outlet": "o1", "id_ext_link": link, "id_platform": "p", "platform_name": f"P{i}", "segment_type": "restaurant",
            "created_at": DAY if ok else "n/a", "file_row_number": i, **more}


def item(i, link, price="1", bev="b1", **more):
    return {"id_outlet": "o1", "id_beverage": bev, "id_ext_link": link, "item_price": price, "created_at": DAY, "item_name": f"n{i}", "file_row_number": i, **more}


def match(i, flag="0", ok=True):
    return {"id_outlet": "o1", "is_chain": flag, "created_at": DAY if ok else "", "file_row_number": i}


LOADS = [
    {"outlet": [outlet(1, "a"), outlet(2, "a"), outlet(3, "z", id_outlet="o9", id_platform="q")],
     "portfolio": [item(1, "a"), item(2, "a", bev="b2"), item(3, "z"), item(3, "z"), item(4, None), item(9, "a", source_file=None)], "matching": [match(1), match(2, "1")]},
    # a second copy of key 2 without a price takes item 2 out; a bad match takes the chain flag off
    {"outlet": [outlet(4, "b")], "portfolio": [item(2, "a", price="x"), item(5, "b"), item(5, "b")], "matching": [match(2, ok=False)]},
    # an outlet goes, and with it the fan-out of its link; a row of a key rejected before stays out; a bad row without a file takes nothing out
    {"outlet": [outlet(2, "a", ok=False)], "portfolio": [item(2, "a"), item(6, "a", bev="b1", created_at="2024-02-01 00:00:00"), item(9, "a", price=None, source_file=None)],
     "matching": [match(3, "1")]},
    {"outlet": [], "portfolio": [], "matching": []},
]


def frames(spark, load):
    return {s: bronze(spark, s, r).withColumn("load_timestamp", F.lit(dt.datetime(2024, 6, 1)).cast("timestamp_ntz")) for s, r in load.items()}


def rebuilt(spark, loads):
    valid = {}
    for s in deltas.Incremental.SOURCES:
        staged = conform.STAGERS[s](frames(spark, {s: [r for load in loads for r in load[s]]})[s])
        valid[s], _ = quality.split(staged, quality.RULES[s])
    out = {f"valid_{s}": v for s, v in valid.items()}
    out |= {"dim_product": dims.dim_product(valid["portfolio"]), "dim_platform": dims.dim_platform(valid["outlet"]), "dim_outlet": dims.dim_outlet(valid["outlet"], valid["matching"])}
    return out | {"fct_outlet_product_listing": facts.fct_listing(valid["portfolio"], out["dim_outlet"])}


def test_every_load_equals_a_rebuild(spark, tmp_dir):
    state = deltas.Incremental(spark, tmp_dir)
    for n, load in enumerate(LOADS):
        changes = state.apply(frames(spark, load))
        for name, full in rebuilt(spark, LOADS[: n + 1]).items():
            assert rows(state.logs[name].current()) == rows(full), (n, name)
        if n == 1:
            assert {r.id_ext_link for r in changes["fct_outlet_product_listing"].collect()} == {"a", "b"}  # link z isn't touched
            assert [(r.file_row_number, r[deltas.CHANGE]) for r in changes["valid_portfolio"].filter("_change < 0").collect()] == [(2, -1)]
        if n == 3:
            assert all(c.count() == 0 for c in changes.values())


def test_a_replayed_load_leaves_one_copy(spark, tmp_dir):
    state = deltas.Incremental(spark, tmp_dir, ("portfolio",))
    state.apply({"portfolio": frames(spark, LOADS[0])["portfolio"]})
    log = state.logs["valid_portfolio"]
    before = rows(log.current())
    log.add(layers.materialize(log.before(), "again"), 0)
    assert rows(log.current()) == before and log.loads == [0]


@pytest.mark.parametrize("small", [True, False])
def test_rows_of_keys_match_nulls(spark, small):
    df = spark.createDataFrame([("a", None, 1), (None, None, 2), ("a", "b", 3)], "m string, n string, v int")
    keys = spark.createDataFrame([("a", None), (None, None)], "m string, n string")
    assert sorted(r.v for r in deltas.of_keys(df, keys, small).collect()) == [1, 2]


def test_a_log_that_only_grew_is_not_moved(spark, tmp_dir):
    log = spark.createDataFrame([("a", 1, 1), ("a", 1, 1), ("b", None, 2), (None, 3, 1)], "m string, v int, _change int")
    assert rows(deltas.current(log)) == rows(spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), (None, 3)], "m string, v int"))
    assert "Exchange" not in deltas.current(log)._jdf.queryExecution().executedPlan().toString()
    out = log.unionByName(spark.createDataFrame([("a", 1, -1), ("b", None, -2)], log.schema))
    assert rows(deltas.current(out)) == rows(spark.createDataFrame([("a", 1), (None, 3)], "m string, v int"))


def test_near_keys_hold_all_rows_of_the_keys(spark):
    df = spark.createDataFrame([("a", None, 1), (None, None, 2), ("a", "b", 3)], "m string, n string, v int")
    keys = spark.createDataFrame([("a", None), (None, None)], "m string, n string")
    assert {1, 2} <= {r.v for r in deltas.near_keys(df, keys).collect()}


def rebuilt_portfolio(spark, loads):
    staged = conform.STAGERS["portfolio"](frames(spark, {"portfolio": [r for load in loads for r in load]})["portfolio"])
    valid, _ = quality.split(staged, quality.RULES["portfolio"])
    return {"valid_portfolio": valid, "dim_product": dims.dim_product(valid)}


@pytest.mark.parametrize("most", [deltas.BROADCAST_BYTES, 0])
def test_products_follow_their_latest_listing(spark, tmp_dir, monkeypatch, most):
    monkeypatch.setattr(deltas, "BROADCAST_BYTES", most)
    r = random.Random(4)
    days = [None, DAY, "2024-02-01 00:00:00", "2024-03-01 00:00:00"]
    some = lambda: item(r.randrange(60), "a", price=r.choice(["1", "1", "1", "x"]), bev=r.choice(["b1", "b2", "b3", "b4", None]), created_at=r.choice(days),
                        market=r.choice(["USA", "USA", "FR", None]), source_file=r.choice(["f", "f", "g", None]), item_name=r.choice(["n", "m"]))
    loads = [[some() for _ in range(n)] for n in (40, 15, 25)]
    # every listing of a product goes out, and the product comes back
    loads[0].append(item(90, "a", bev="b9"))
    loads[1].append(item(90, "a", bev="b9", price="x"))
    loads[2] += [item(91, "a", bev="b9"), item(91, "a", bev="b9")]
    state = deltas.Incremental(spark, tmp_dir, ("portfolio",))
    for n, load in enumerate(loads):
        state.apply(frames(spark, {"portfolio": load}))
        for name, full in rebuilt_portfolio(spark, loads[: n + 1]).items():
            assert rows(state.logs[name].current()) == rows(full), (n, name)


def test_new_listings_are_not_compared_with_all_earlier_ones(spark, tmp_dir):
    loads = [[item(1, "a"), item(2, "a", bev="b2")], [item(3, "a", created_at="2024-02-01 00:00:00"), item(4, "a", bev="b2", created_at=None)]]
    state = deltas.Incremental(spark, tmp_dir, ("portfolio",))
    state.apply(frames(spark, {"portfolio": loads[0]}))
    log = state.logs["valid_portfolio"]
    keys = log.before().select(*quality.KEYS, deltas.CHANGE)
    log.before = lambda: keys  # nothing else of the earlier listings is there
    changes = state.apply(frames(spark, {"portfolio": loads[1]}))["dim_product"]
    assert sorted((c.id_beverage, c.item_name, c[deltas.CHANGE]) for c in changes.collect()) == [("b1", "n1", -1), ("b1", "n3", 1)]
    assert rows(state.logs["dim_product"].current()) == rows(rebuilt_portfolio(spark, loads)["dim_product"])


def test_a_load_reads_the_files_of_its_own_rows(spark, tmp_dir):
    spark.createDataFrame([(i, i % 5, f"R{i}") for i in range(5)], "r_regionkey long, n long, r_name string").write.parquet(f"{tmp_dir}/region.parquet")
    events = [(i, dt.datetime(2024, 1, 1), i, "click", 1.0) for i in [*range(20), 71, 71, 142, None]]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{tmp_dir}/events.parquet")
    loads = [load["matching"] for load in queries._three_loads(spark, tmp_dir, ("matching",))]
    numbers = [sorted((r.file_row_number, r.created_at != "") for r in load.collect()) for load in loads]
    whole = lambda *parts: [(i, True) for i in [*range(20), 71, 71, 142] if i % 5 in parts]
    assert numbers == [whole(0, 1, 2), whole(3), sorted(whole(4) + [(0, False), (71, False), (71, False), (142, False)])]
    files = [{r[0] for r in load.select(F.input_file_name()).collect()} for load in loads]
    assert not files[0] & files[1] and not files[0] & files[2] and not files[1] & files[2]
