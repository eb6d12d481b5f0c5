"""Layer tables (S14-S16, S18-S20): write, replace and read back.

Layers are parquet folders under a base path, routed by layer name
(bronze, silver, gold, audit) like the reference's schema routing; the
intermediate models live in the silver namespace.  Tables that carry a
canonical market are partitioned by it, so per-market reads (row access,
one-market runs, backfills) prune partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# Model folder -> namespace routing (intermediate -> SILVER).
LAYER_NAMESPACE = {"bronze": "BRONZE", "silver": "SILVER", "intermediate": "SILVER",
                   "audit": "AUDIT", "gold": "GOLD", "security": "SECURITY"}


#: Compression of the tables' files: a third smaller than the default's.
CODEC = "zstd"


def namespace(layer: str, default: str = "PUBLIC") -> str:
    """Custom schema if the layer has one (trimmed), else the target default."""
    ns = LAYER_NAMESPACE.get(layer)
    return default if ns is None else ns.strip()


def table_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{namespace(layer)}/{name}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: tuple[str, ...] = (), only_touched_partitions: bool = False) -> None:
    """CTAS / INSERT OVERWRITE (mode='overwrite') or append.

    ``only_touched_partitions`` replaces just the partitions present in
    ``df`` (dynamic partition overwrite): a one-market rebuild or backfill
    leaves every other market's files untouched."""
    w = df.write.mode(mode).option("compression", CODEC)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if only_touched_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


# An empty string has no partition folder of its own (it would be read back as
# NULL), so it and strings of marks only are written with one mark more.
_MARK = "\u0001"


def _folder_value(c: str) -> Column:
    return F.when(F.col(c).rlike(f"^{_MARK}*$"), F.concat(F.lit(_MARK), F.col(c))).otherwise(F.col(c)).alias(c)


def _value(c: str) -> Column:
    return F.when(F.col(c).rlike(f"^{_MARK}+$"), F.substring(c, 2, 1 << 30)).otherwise(F.col(c)).alias(c)


def to_folders(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """``df`` with its partition columns as they are written."""
    return df.select(*[_folder_value(c) if c in partition_by else c for c in df.columns])


def from_folders(df: DataFrame, columns: list[str], partition_by: tuple[str, ...]) -> DataFrame:
    """A table read back, with its partition columns as they were; a filter
    on one still prunes folders."""
    return df.select(*[_value(c) if c in partition_by else c for c in columns])


def partition_folder(spark: SparkSession, path: str, column: str, value: str | None) -> str:
    """The folder of one value, escaped as Spark writes it."""
    if value is not None and not value.strip(_MARK):
        value = _MARK + value
    return f"{path}/{spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)}"


def _drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True).close()


def marks(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none where it doesn't exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_layer(df: DataFrame, base: str, layer: str, name: str, mode: str = "overwrite",
                partition_by: tuple[str, ...] | None = None,
                only_touched_partitions: bool = False, touched: list[str] | None = None) -> DataFrame:
    """Write a model's table into its layer namespace and return a DataFrame
    that reads it back (the lineage is cut at the layer edge).  ``touched``:
    the markets that were rebuilt; one whose rebuild yields no rows loses its
    partition."""
    if partition_by is None:
        partition_by = ("market",) if "market" in df.columns else ()
    path = table_path(base, layer, name)
    spark, out = df.sparkSession, to_folders(df, partition_by)
    if touched:
        # the rebuild is evaluated once; which markets it has comes from its own table
        out = materialize(out, f"rebuilt-{name}")
    write_table(out, path, mode, partition_by, only_touched_partitions)
    if touched:
        column = partition_by[0]
        back = from_folders(out.select(column).distinct(), [column], partition_by)
        left = {r[0] for r in back.collect()}  # at most the rebuilt markets
        for value in set(touched) - left:
            _drop_folder(spark, partition_folder(spark, path, column, value))
    # the known schema: no footer sampling, and an empty table reads back empty
    return from_folders(spark.read.schema(df.schema).parquet(path), df.columns, partition_by)  # keep the model's column order


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to a fresh folder in the shared checkpoint area and
    read it back: every later consumer scans parquet (pruned, pushed down)
    instead of recomputing the lineage.  Survives executor loss."""
    spark = df.sparkSession
    path = shared_dir(spark, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    write_table(df, path, partition_by=partition_by)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a bucket, about: a task sorts them in its memory.
BUCKET_ROWS = 500_000


def buckets(rows: int, least: int, each: int = BUCKET_ROWS) -> int:
    """Buckets of a table of about ``rows`` rows, so that a bucket doesn't grow
    with the table.  Tables joined by their buckets need the same number."""
    return max(least, -(-rows // each))


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """A layer table dealt to buckets by ``keys`` and sorted by them: joins and
    aggregates on these keys with a table of as many buckets need no
    exchange.  Its files are in the shared folder; the table's name is unique."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    path = shared_dir(spark, "tables", table)
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).option("compression", CODEC).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


def layer_persister(base: str):
    """``persist`` callback for plans.build.build: one table per model."""
    def persist(df: DataFrame, layer: str, name: str) -> DataFrame:
        return write_layer(df, base, layer, name)
    return persist


def register_views(tables: dict[str, DataFrame], layer: str | None = None) -> list[str]:
    """Expose models as session views (S19: every model a view), named
    ``<namespace>__<model>`` when a layer is given.  Views are lazy: a read
    re-plans from the underlying tables, nothing is computed here."""
    names = []
    for name, df in tables.items():
        view = f"{namespace(layer).lower()}__{name}" if layer else name
        df.createOrReplaceTempView(view)
        names.append(view)
    return names
