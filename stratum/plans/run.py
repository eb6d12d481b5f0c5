"""An end-to-end layered run: landed files -> bronze -> silver -> gold -> checks.

The counterpart of a full warehouse build.  Every layer is a table in its
namespace under ``warehouse`` (BRONZE, SILVER, GOLD, AUDIT); each step reads
the tables of the step before, so every source's bronze rows are scanned
once per build and a gold read touches only gold tables.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import audit, checks, labels, monitoring
from ..sources import constants, ingest, layers
from ..sources.schemas import SOURCE_FOLDERS
from . import build


@dataclass
class RunResult:
    bronze: dict[str, DataFrame]
    layers: build.Layers
    checks: DataFrame
    coverage: DataFrame
    file_issues: DataFrame
    labels: DataFrame  # the review table with this run's predictions


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; one caller only succeeds."""
    fs, p = _path(spark, path)
    try:
        fs.create(p, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise


def _next_number(spark: SparkSession, folder: str) -> int:
    """A load number that no other load has or will get."""
    number = 0
    while not _claim(spark, f"{folder}/load={number}.claim"):
        number += 1
    return number


def committed(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the committed loads, in the order of their commits."""
    fs, p = _path(spark, f"{folder}/commits")
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    at = {int(n.split("-")[0]): int(n.split("=")[1]) for n in names if "-load=" in n}
    return [at[i] for i in sorted(at)]


def _commit(spark: SparkSession, folder: str, number: int, seen: int) -> bool:
    """Make load ``number`` the commit after ``seen`` others; False if another
    load came first."""
    return _claim(spark, f"{folder}/commits/{seen}.lock") and _claim(spark, f"{folder}/commits/{seen}-load={number}")


def _committed_beyond(spark: SparkSession, folder: str, seen: int, seconds: int = 60) -> list[int]:
    """The committed loads once there are more than ``seen``; an error where a
    load died between its two marks (its lock then has to be deleted)."""
    for _ in range(seconds):
        now = committed(spark, folder)
        if len(now) > seen:
            return now
        time.sleep(1)
    raise RuntimeError(f"a load died in its commit: no load for {folder}/commits/{seen}.lock")


def copy_files(spark: SparkSession, source: str, target: str, chosen) -> int:
    """Copy the files of a folder, folders kept, whose place in the order of
    their names is ``chosen``; returns how many."""
    fs, p = _path(spark, source)
    jvm, files, it = spark._jvm, [], fs.listFiles(p, True)
    while it.hasNext():
        files.append(it.next().getPath())
    files = sorted((f for f in files if not f.getName().startswith(("_", "."))), key=lambda f: f.toString())
    base = fs.makeQualified(p).toString().rstrip("/")
    todo = [f for i, f in enumerate(files) if chosen(i)]
    for f in todo:
        to = jvm.org.apache.hadoop.fs.Path(f"{target}/{f.toString()[len(base) + 1:]}")
        fs.mkdirs(to.getParent())
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, f, fs, to, False, spark._jsc.hadoopConfiguration())
    return len(todo)


def _write_load(df: DataFrame, path: str, number: int, by_market: bool = False) -> None:
    """Write one load's folder of a table, by market where it has one."""
    layers.write_table(layers.to_folders(df, ("market",)) if by_market else df, f"{path}/load={number}", partition_by=("market",) if by_market else ())


def read_loads(spark: SparkSession, schema, path: str, loads: list[int], by_market: bool = False) -> DataFrame:
    """A table with the given loads; a filter on market reads its folders only."""
    if not loads:
        return spark.createDataFrame([], schema)
    by = ("market",) if by_market else ()
    back = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/load={n}" for n in loads])
    return layers.from_folders(back, schema.fieldNames(), by)


def _files_of(spark: SparkSession, folder: str, loads: list[int]) -> DataFrame:
    return read_loads(spark, T.StructType([T.StructField("file", T.StringType())]), folder, loads)


def load_bronze(spark: SparkSession, landing_root: str, warehouse: str, load_ts: str,
                sources=tuple(SOURCE_FOLDERS)) -> tuple[dict, DataFrame]:
    """Ingest every source's new files and append its raw and parsed bronze
    tables (folders by load and market).  Returns the parsed tables (with the
    raw text carried along) and the bad files of this load.

    Each file is loaded once.  A load claims a number of its own, writes its
    folders, and is read only once it is committed: commits follow each other
    one by one, and a load that finds one of its files committed by another
    meanwhile is given up.  What a failed load left is never read; its files
    are loaded by the next one."""
    def one(source):
        name = SOURCE_FOLDERS[source]
        path = {t: layers.table_path(warehouse, layer, f"{name}_{t}")
                for t, layer in (("RAW", "bronze"), ("PARSED", "bronze"), ("PARSE_ISSUES", "audit"), ("FILES", "audit"))}
        before = committed(spark, path["FILES"])
        # only names are listed; a file's content is not read
        landed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{landing_root.rstrip('/')}/{name}").select(F.col("path").alias("file"))
        new = sorted(r[0] for r in landed.join(_files_of(spark, path["FILES"], before), "file", "left_anti").collect())
        number = _next_number(spark, path["FILES"])
        load = ingest.ingest(spark, landing_root, source, load_ts, keep_raw=True, files=new)
        _write_load(load.raw, path["RAW"], number, by_market=True)
        _write_load(load.parse_issues, path["PARSE_ISSUES"], number, by_market=True)
        _write_load(load.parsed, path["PARSED"], number, by_market=True)
        _write_load(spark.createDataFrame([(f,) for f in new], "file string"), path["FILES"], number)
        done = before
        while not _commit(spark, path["FILES"], number, len(done)):
            now = _committed_beyond(spark, path["FILES"], len(done))
            fresh = _files_of(spark, path["FILES"], now[len(done):])
            if fresh.filter(F.col("file").isin(new)).limit(1).count():
                raise RuntimeError(f"another load of {name} has taken files of load {number}; it is given up")
            done = now
        loads = committed(spark, path["FILES"])
        issues = load.file_issues.selectExpr(f"'{source}' as source_name", "*")
        return source, read_loads(spark, load.parsed.schema, path["PARSED"], loads, by_market=True), issues

    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        done = list(pool.map(one, sources))
    issues = checks.union_all([i for _, _, i in done])
    return {s: p for s, p, _ in done}, issues


def score_new_listings(listings: DataFrame, warehouse: str, scored_at: str, scorer=None) -> DataFrame:
    """C4: label the listings in scope whose text has no prediction yet and
    append them to the review table; the whole table."""
    scoped = labels.scope_sample(listings)
    earlier = labels.read_predictions(listings.sparkSession, warehouse, labels.to_review_table(labels.label(scoped), scored_at).schema)
    todo = scoped if earlier is None else monitoring.to_score(scoped, earlier)
    return labels.append_predictions(labels.to_review_table(labels.label(todo, scorer), scored_at), warehouse)


def run(spark: SparkSession, landing_root: str, warehouse: str, load_ts: str,
        scope: DataFrame | None = None, accepted_markets=None) -> RunResult:
    """Load, build all layers, run the declared checks and the coverage audit."""
    scope = scope if scope is not None else constants.reference_scope(spark)
    accepted = tuple(accepted_markets or (m for m, _ in constants.REFERENCE_MARKETS))
    bronze, issues = load_bronze(spark, landing_root, warehouse, load_ts)
    # INSERT OVERWRITE of the role x market entitlement table
    layers.write_layer(constants.entitlements(scope), warehouse, "security", "role_market_entitlements",
                       mode="overwrite", partition_by=())
    lay = build.build(bronze, scope, persist=layers.layer_persister(warehouse))
    layers.register_views(lay.gold, "gold")
    expected = constants.expected_coverage(scope)
    coverage = layers.write_layer(audit.coverage_audit(bronze, expected), warehouse, "audit",
                                  "source_coverage_audit", partition_by=())
    tables = {"stg_outlets": lay.staged["outlet"], "stg_portfolio": lay.staged["portfolio"],
              "stg_matching": lay.staged["matching"],
              "int_outlets_valid": lay.valid["outlet"], "int_portfolio_valid": lay.valid["portfolio"],
              "int_matching_valid": lay.valid["matching"],
              "int_outlets_rejected": lay.rejected["outlet"], "int_portfolio_rejected": lay.rejected["portfolio"],
              "int_matching_rejected": lay.rejected["matching"],
              "missing_source_coverage": audit.missing_coverage(bronze, expected), **lay.gold}
    results = layers.write_layer(checks.run_checks(checks.declared_suite(accepted), tables), warehouse,
                                 "audit", "check_results", partition_by=())
    review = score_new_listings(lay.valid["portfolio"], warehouse, load_ts)
    return RunResult(bronze, lay, results, coverage, issues, review)
