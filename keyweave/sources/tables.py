"""Table schemas, catalog tables, the key file, and items kept in buckets.

Batches can be repeated: a batch of seed ids has a partition of its own in every table and in the key file, which a rerun overwrites. The key
file is written last, so its partitions are the ledger of the batches that are whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.operators.amplify import KEY_COLUMNS, item_columns, put_items

BATCH = ["version", "startingId"]
KEYFILE_PARTITIONS = ["version", "dt", "startingId"]
BUCKETING = ["kw_buckets", "kw_bucket"]


def schema_from_header(spark: SparkSession, path: str) -> T.StructType:
    """All-text schema named by the header of a CSV file; its rows, if any, don't matter."""
    return spark.read.option("header", True).csv(path).schema


def resolve_schema(spark: SparkSession, table: str, header_path: str | None = None) -> T.StructType:
    """Schema of the catalog table ``table`` without what tells its batches apart, or where there is none that of the CSV file."""
    if spark.catalog.tableExists(table):
        own = spark.table(table).schema
        return T.StructType([f for f in own.fields if f.name not in BATCH]) if keeps_batches(own) else own
    if header_path is None:
        raise ValueError(f"table {table} does not exist and no header file is given")
    return schema_from_header(spark, header_path)


def keeps_batches(schema: T.StructType) -> bool:
    return [f.name for f in schema.fields[-len(BATCH):]] == BATCH


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    """Rows of a catalog table."""
    return spark.table(table)


def append_to_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """Appends to a Parquet table of the catalog, which the first write creates, Snappy-compressed and partitioned if asked."""
    writer = df.write.mode("append").format("parquet").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


@contextmanager
def _own_partitions_only(spark: SparkSession) -> Iterator[None]:
    """Within it, overwriting replaces the partitions that are written and leaves all others."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_batch(df: DataFrame, table: str, version: str, starting_id: int) -> None:
    """Puts a batch into a Parquet table of the catalog, in place of what an earlier run of the same batch left there. A table that was
    made without batches is appended to."""
    spark = df.sparkSession
    marked = df.withColumns({"version": F.lit(str(version)), "startingId": F.lit(int(starting_id)).cast("bigint")})
    if not spark.catalog.tableExists(table):
        append_to_table(marked.limit(0), table, BATCH)
    own = spark.table(table).schema
    if not keeps_batches(own):
        append_to_table(df.select(*own.names), table)
        return
    with _own_partitions_only(spark):
        marked.select(*own.names).write.mode("overwrite").insertInto(table)


def write_keyfile(keys: DataFrame, path: str) -> None:
    """Puts keys into a key file: Parquet, a folder for each version, day and batch, which a rerun of the batch on that day replaces."""
    with _own_partitions_only(keys.sparkSession):
        keys.write.mode("overwrite").partitionBy(*KEYFILE_PARTITIONS).parquet(path)


def scan_keyfile(spark: SparkSession, path: str, below: str = "") -> DataFrame:
    """Keys of a key file, or of the part in the folder ``below`` it (``version=1``); version, day and first id are columns either way."""
    reader = spark.read.option("basePath", path)
    found = reader.parquet(f"{path.rstrip('/')}/{below}" if below else path)
    kinds = {"version": "string", "dt": "string", "startingId": "bigint"}
    return found.withColumns({c: found[c].cast(kinds[c]) for c in KEYFILE_PARTITIONS if c in found.columns})


def made_batches(spark: SparkSession, keyfile: str) -> DataFrame:
    """The ledger: version, startingId and number of rows of the batches in a key file, none where there is no file."""
    try:
        keys = scan_keyfile(spark, keyfile)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "version string, startingId long, rows long")
    return keys.groupBy(*BATCH).agg(F.count(F.lit(1)).alias("rows"))


def is_made(spark: SparkSession, keyfile: str, version: str, starting_id: int, rows: int) -> bool:
    """Whether the ledger has this batch; an error if it has others of the version that share seed ids with it."""
    clash = made_batches(spark, keyfile).where((F.col("version") == str(version)) & (F.col("startingId") < starting_id + rows)
                                               & (F.col("startingId") + F.col("rows") > starting_id)).take(2)
    if clash and [(r.startingId, r.rows) for r in clash] != [(starting_id, rows)]:
        raise ValueError(f"ids {starting_id} to {starting_id + rows - 1} of version {version} overlap the batch of {clash[0].rows} from {clash[0].startingId}")
    return bool(clash)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scan_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of a store of buckets; attributes that a bucket's items never had are null."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(*BUCKETING)


def finish_put(spark: SparkSession, path: str) -> None:
    """Ends a put that was cut off: a staged result that is whole is moved into its buckets, again if need be, any other is thrown away."""
    staged = f"{path.rstrip('/')}/_put"
    if _exists(spark, f"{staged}/_SUCCESS"):
        whole = spark.read.option("mergeSchema", True).parquet(staged)
        with _own_partitions_only(spark):
            whole.write.mode("overwrite").partitionBy(*BUCKETING).parquet(path)
    if _exists(spark, staged):
        _remove(spark, staged)


def put_into(path: str, batch: DataFrame, order_by: str, buckets: int = 64, keys: list[str] = KEY_COLUMNS) -> None:
    """``put_items`` into a store of buckets by hash of the partition key: a put reads and replaces only the buckets that its batch falls into.

    ``buckets`` is fixed by the first put. The new contents of the buckets are staged before any is replaced, so that a put that is cut off is
    either ended by the next one (``finish_put``) or hasn't happened. Puts into one store must not run at the same time.
    """
    spark = batch.sparkSession
    finish_put(spark, path)
    marked = item_columns(batch).withColumns({"kw_buckets": F.lit(buckets), "kw_bucket": _bucket(keys[:1], buckets)})
    hit = [r[0] for r in marked.select("kw_bucket").distinct().collect()]
    stored = marked.limit(0)
    try:
        there = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        other = there.where(F.col("kw_buckets") != buckets).select("kw_buckets").take(1)
        if other:
            raise ValueError(f"the store at {path} has {other[0][0]} buckets, not {buckets}")
        stored = there.where(F.col("kw_bucket").isin(hit))
    both = put_items(stored, marked, order_by, [*BUCKETING, *keys])
    staged = f"{path.rstrip('/')}/_put"
    both.write.partitionBy(*BUCKETING).parquet(staged)
    finish_put(spark, path)
