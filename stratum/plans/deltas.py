"""Layers kept up to date load by load (delta propagation with retractions).

Every table is a log of signed rows, one folder per load: a row with
``_change`` = 1 came in, -1 went out.  A load writes only what it changes:

- valid: new rows whose key has no rejected row come in; a new rejected row
  takes the earlier valid rows of its key out.  With S staged and R rejected
  rows this is  d(S anti R) = dS anti (R + dR) - (S anti R) semi dR.
- dimensions: the keys of changed valid rows are derived again from their own
  valid rows; what differs from the table comes in and goes out.  A product
  keeps the listing that describes it: new listings are compared with that one,
  and only a product whose listing went out is derived from all of its own.
- fact: d(L join O) = dL join O' + L join dO, for listings L and outlets O,
  with O' after the load.

``current`` adds the signs up.  A load's cost follows its own rows and the
rows that share their keys: logs are read with a semi join on the changed
keys, whose hashes are broadcast where they are few, and signs are added up
only for rows that also went out, so logs aren't shuffled.  Many rejected keys
meet the valid rows by a shuffle of one number a row.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import conform, dims, facts, quality
from ..sources import layers
from . import run

CHANGE = "_change"
#: Bytes of hashes of changed keys that may be broadcast; more are joined by
#: shuffle.  A hash takes about HASH_BYTES in a broadcast table.
BROADCAST_BYTES = 64 << 20
HASH_BYTES = 32


def signed(df: DataFrame, sign: int) -> DataFrame:
    return df.withColumn(CHANGE, F.lit(sign))


def _rows(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != CHANGE]


def net(log: DataFrame) -> DataFrame:
    """One row per different row, with the sum of its signs, without zeros."""
    return log.groupBy(*_rows(log)).agg(F.sum(CHANGE).cast("int").alias(CHANGE)).filter(F.col(CHANGE) != 0)


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows with a positive sign, each as often as it says."""
    times = F.explode(F.sequence(F.lit(1), F.col(CHANGE)))
    return rows.filter(F.col(CHANGE) > 0).withColumn("_time", times).drop(CHANGE, "_time")


def current(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The table that a log stands for, repeated rows kept.  Only rows that
    also went out are added up: they are found by the hashes of the signs
    below 0, so a log that only grew isn't moved at all.  ``by``: the columns
    to hash, all by default; fewer are read faster and add up more rows."""
    row = F.xxhash64(*(by or _rows(log)))
    out, small = _kept_hashes(log.filter(F.col(CHANGE) < 0).select(row.alias("_h")), "rows-out")
    if small and out.isEmpty():
        return _repeated(log)
    if not small:
        return _repeated(net(log))
    hashed = log.withColumn("_h", row)
    doubted = hashed.join(F.broadcast(out), "_h", "left_semi").drop("_h")
    return _repeated(hashed.join(F.broadcast(out), "_h", "left_anti").drop("_h")).unionByName(_repeated(net(doubted)))


def negated(log: DataFrame) -> DataFrame:
    return log.withColumn(CHANGE, -F.col(CHANGE))


def difference(log: DataFrame, new: DataFrame) -> DataFrame:
    """Signed rows that turn the table of ``log`` into ``new``."""
    return net(signed(new, 1).unionByName(negated(log)))


def near_keys(df: DataFrame, keys: DataFrame, small: bool = True) -> DataFrame:
    """Rows of ``df`` whose keys have the hash of one of the ``keys`` (few, if
    ``small``): all rows of these keys, and rows of others whose hash is the same."""
    names = keys.columns
    hashes = keys.select(F.xxhash64(*names).alias("_h"))
    return df.withColumn("_h", F.xxhash64(*names)).join(F.broadcast(hashes) if small else hashes, "_h", "left_semi").drop("_h")


def of_keys(df: DataFrame, keys: DataFrame, small: bool) -> DataFrame:
    """Rows of ``df`` with one of the keys (distinct; NULL equals NULL).  Few
    keys are broadcast as hashes; only rows that these find are compared."""
    if small:
        df = near_keys(df, keys)
    keys = keys.select(*[F.col(c).alias(f"_k_{c}") for c in keys.columns])
    on = None
    for c in keys.columns:
        same = df[c[3:]].eqNullSafe(keys[c])
        on = same if on is None else on & same
    return df.join(keys, on, "left_semi")


class Log:
    """The signed rows of one table, a folder per load.  ``by``: columns that
    tell its rows apart well enough for ``current``.  ``beside``: columns that
    are written with the rows and aren't the table's."""

    def __init__(self, spark: SparkSession, path: str, by: list[str] | None = None, beside: tuple[str, ...] = ()):
        self.spark, self.path, self.by, self.beside = spark, path, by, beside
        self.loads, self.schema = [], None

    def _read(self, loads: list[int]) -> DataFrame:
        return run.read_loads(self.spark, self.schema, self.path, loads).drop(*self.beside)

    def before(self) -> DataFrame | None:
        """The log of all loads so far; None before the first."""
        return self._read(self.loads) if self.loads else None

    def numbered(self) -> DataFrame:
        """The same with the columns beside and the number of the load."""
        return run.read_loads(self.spark, T.StructType([*self.schema.fields, T.StructField("load", T.IntegerType())]), self.path, self.loads)

    def add(self, changes: DataFrame, load: int) -> DataFrame:
        """Write one load's changes; a replay writes the same folder again."""
        layers.write_table(changes, f"{self.path}/load={load}")
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in changes.schema])
        if load not in self.loads:
            self.loads.append(load)
        return self._read([load])

    def current(self) -> DataFrame:
        return current(self.before(), self.by)


def _few(rows: DataFrame) -> bool:
    """Whether the hashes of the rows of a written table may be broadcast."""
    return rows.count() * HASH_BYTES <= BROADCAST_BYTES


def _kept_keys(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, bool]:
    """The distinct keys, written once, and whether their hashes are few."""
    kept = layers.materialize(df.select(*keys).distinct(), name)
    return kept, _few(kept)


def _kept_hashes(hashes: DataFrame, name: str) -> tuple[DataFrame, bool]:
    return _kept_keys(hashes, ["_h"], name)


class Incremental:
    """Valid rows, dimensions and fact of the three sources under new loads."""

    SOURCES = ("outlet", "portfolio", "matching")

    def __init__(self, spark: SparkSession, base: str, sources=SOURCES):
        self.spark, self.base, self.sources, self.load = spark, base.rstrip("/"), tuple(sources), -1
        names = [f"{kind}_{s}" for s in self.sources for kind in ("rejected", "valid")]
        names += ["dim_platform", "dim_outlet", "dim_product", "fct_outlet_product_listing"]
        self.logs = {n: Log(spark, f"{self.base}/{n}", None if n.startswith("dim_") else quality.KEYS, tuple(dims.PRODUCT_ORDER_COLS) if n == "dim_product" else ())
                     for n in names}

    def _valid(self, source: str, bronze: DataFrame) -> DataFrame:
        """The load's signed valid rows."""
        staged = conform.STAGERS[source](bronze)  # one projection of the load's table
        rejected, valid = self.logs[f"rejected_{source}"], self.logs[f"valid_{source}"]
        bad_before, valid_before = rejected.before(), valid.before()
        bad_now = rejected.add(quality.rejected(staged, quality.RULES[source]).select(*quality.KEYS), self.load)
        changes = signed(quality.settled(staged, quality.RULES[source], source, bad_before, bad_now, _few(rejected.before())), 1)
        if valid_before is not None:
            # a key with a NULL part matches nothing, so it takes nothing out
            met = quality.met_keys(valid_before, bad_now, f"gone-{source}", _few(bad_now))
            if not met.isEmpty():
                keys = quality.keys_of(bad_now, met, f"rejected-keys-{source}")
                changes = changes.unionByName(negated(net(of_keys(valid_before, keys, _few(keys)))))
        return valid.add(changes, self.load)

    def _derive(self, name: str, keys: list[str], touched: DataFrame, derive) -> DataFrame:
        """Derive the rows of the touched keys again; the signed difference to
        the table.  ``derive`` gets a function that restricts a log.  Rows of
        other keys may be derived too, they come out as they were: so few keys
        are found by their hashes, and for many the whole log is taken."""
        log = self.logs[name]
        before = log.before()
        near = lambda rows: rows
        if before is not None:
            found, small = _kept_keys(touched, keys, f"touched-{name}")
            near = lambda rows: near_keys(rows, found) if small else rows
        # only the columns that the dimension reads, and the row key
        new = derive(lambda table, columns: current(near(table.before()).select(*dict.fromkeys([*columns, *quality.KEYS]), CHANGE), table.by))
        return log.add(signed(new, 1) if before is None else difference(near(before), new), self.load)

    def _products(self, changes: DataFrame) -> DataFrame:
        """The load's signed rows of dim_product, whose log also holds the
        order of the listing that describes a product.  That listing is the
        one of the product's last load (``held``); it goes out for a listing
        before it in the order, or where it is taken out itself: such products
        are derived again from all their listings."""
        log, listings, keys = self.logs["dim_product"], self.logs["valid_portfolio"], ["market", "id_beverage"]
        columns = [*dims.PRODUCT_COLS, *dims.PRODUCT_ORDER_COLS]
        hashed = lambda rows: rows.withColumn("_h", F.xxhash64(*keys))
        # the hash goes first: sorting compares a number and no texts
        latest = lambda rows: dims.latest_per_key(hashed(dims.product_listings(rows)), ["_h", *keys], dims.product_order())
        written = lambda rows, *more: dims.product_rows(rows, *dims.PRODUCT_ORDER_COLS, *more)
        if not log.loads:
            return log.add(signed(written(latest(listings.current())), 1), self.load)
        held, new = log.numbered(), latest(changes.filter(F.col(CHANGE) > 0))
        if _few(changes):
            held = near_keys(held, changes.select(*keys).distinct())
        taken, few = _kept_keys(changes.filter(F.col(CHANGE) < 0), quality.KEYS, "listings-out")
        lost = F.lit(False)
        if not taken.isEmpty():
            out, few = _kept_keys(hashed(near_keys(held, taken, few)), ["_h"], "products-out")
            again = hashed(listings.before().select(*columns, CHANGE)).join(F.broadcast(out) if few else out, "_h", "left_semi").drop("_h")
            new = new.unionByName(latest(net(again).filter(F.col(CHANGE) > 0)))
            out = out.withColumn("_out", F.lit(True))
            held, lost = hashed(held).join(F.broadcast(out) if few else out, "_h", "left"), F.col("_out").isNotNull()
        held = hashed(held).select("_h", *columns, "load", lost.alias("_lost"), CHANGE)
        new = new.select("_h", *columns, F.lit(None).cast("int").alias("load"), F.lit(False).alias("_lost"), F.lit(1).alias(CHANGE))
        # a listing that went out comes last; of equal ones the held one stays.  One order, so rows are sorted once
        came = F.col("load").isNull()
        product = Window.partitionBy("_h", *keys).orderBy("_lost", *dims.product_order(), came)
        last = F.max("load").over(product.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        rows = held.unionByName(new).withColumn("_last", last).filter(came | ((F.col("load") == F.col("_last")) & (F.col(CHANGE) > 0)))
        rows = rows.withColumn("_place", F.row_number().over(product))
        first = (F.col("_place") == 1) & ~F.col("_lost")
        rows = rows.withColumn(CHANGE, F.when(came & first, F.lit(1)).when(~came & ~first, F.lit(-1))).filter(F.col(CHANGE).isNotNull())
        return log.add(written(rows, CHANGE), self.load)

    def apply(self, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Take in one load; the signed changes of every table."""
        self.load += 1
        logs, out = self.logs, {}
        listings_before = logs["valid_portfolio"].before() if "portfolio" in self.sources else None
        have = set(self.sources)
        # independent tables: their jobs are submitted together
        with ThreadPoolExecutor(max_workers=3) as pool:
            out.update(zip([f"valid_{s}" for s in self.sources], pool.map(lambda s: self._valid(s, bronze[s]), self.sources), strict=True))
            todo = {}
            if "portfolio" in have:
                products = out["valid_portfolio"].filter("id_beverage is not null")
                todo["dim_product"] = lambda: self._products(products)
            if "outlet" in have:
                platforms = out["valid_outlet"].filter("id_platform is not null")
                todo["dim_platform"] = lambda: self._derive("dim_platform", ["market", "id_platform"], platforms, lambda of: dims.dim_platform(of(logs["valid_outlet"], dims.PLATFORM_COLUMNS)))
            if have >= {"outlet", "matching"}:
                keys = ["market", "id_outlet"]
                outlets = out["valid_outlet"].select(*keys).unionByName(out["valid_matching"].select(*keys)).filter("id_outlet is not null")
                todo["dim_outlet"] = lambda: self._derive("dim_outlet", keys, outlets, lambda of: dims.dim_outlet(of(logs["valid_outlet"], dims.OUTLET_COLUMNS), of(logs["valid_matching"], dims.SIGNAL_COLUMNS)))
            out.update(zip(todo, pool.map(lambda step: step(), todo.values()), strict=True))
        if set(self.sources) == set(self.SOURCES):
            out["fct_outlet_product_listing"] = self._fact(out, listings_before)
        return out

    def _fact(self, out: dict[str, DataFrame], listings_before: DataFrame | None) -> DataFrame:
        log, link = self.logs["fct_outlet_product_listing"], ["market", "id_ext_link"]
        listings, outlets = out["valid_portfolio"], facts.outlet_columns(self.logs["dim_outlet"].before(), CHANGE)
        if listings_before is not None and listings.count() < outlets.count():
            links, small = _kept_keys(listings.filter("id_ext_link is not null"), link, "touched-links")
            outlets = near_keys(outlets, links) if small else outlets
        parts = [(listings, signed(current(outlets), 1))]
        if listings_before is not None:
            # most changes of an outlet are of columns that the fact doesn't have
            moved = layers.materialize(net(facts.outlet_columns(out["dim_outlet"], CHANGE)), "moved-outlets")
            links, small = _kept_keys(moved, link, "moved-links")
            parts.append((near_keys(listings_before, links) if small else listings_before, moved))
        changes = None
        for listings, outlets in parts:
            rows = facts.fct_listing(listings, outlets, weights=(CHANGE, CHANGE))
            changes = rows if changes is None else changes.unionByName(rows)
        return log.add(changes, self.load)  # ``current`` adds the signs up
