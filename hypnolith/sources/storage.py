"""Stored tables, epoch layout and CSV exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypnolith.functions.keys import BLOCK, EPOCH_BLOCK, block_of, with_block
from hypnolith.operators.epochs import replace_epochs
from hypnolith.schemas import EPOCH_SEC, EPOCHS, TABLES

REC_BUCKET = "rec_bucket"
# Spark's own limit, raised where the data ask for more buckets.
MOST_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"


def write_epochs(
    epochs: DataFrame,
    path: str,
    buckets: int | None = None,
    block_epochs: int = EPOCH_BLOCK,
    hashed: bool = False,
) -> DataFrame:
    """Store epochs bucketed and sorted by (rec_id, epoch_block), and return the table.

    Joins, windows and de-duplication on that pair then read their bucket without
    shuffling epochs; the sort keeps row-group statistics on ``rec_id`` tight and
    stages run-length friendly. ``buckets`` should be sized for the epochs and not
    be below the shuffle partitions (the default), or joins would shuffle epochs
    into those instead. Each bucket is written by one task as one file;
    ``hashed`` says that the rows already sit in tasks by (rec_id, epoch_block), as
    freshly built epochs do.
    """
    rows = with_block(epochs, block_epochs).select(*EPOCHS.fieldNames(), BLOCK)
    return write_bucketed(rows, path, "epoch_idx", buckets, hashed)


def new_table_name() -> str:
    return f"hypnolith_epochs_{uuid.uuid4().hex}"


def write_bucketed(
    rows: DataFrame,
    path: str,
    order: str,
    buckets: int | None = None,
    hashed: bool = False,
    table: str | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Rows with rec_id and block, stored bucketed on both and sorted by them and ``order``.

    With mode ``append`` they are added to ``table`` as further files of its buckets.
    """
    spark = rows.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _allow_buckets(spark, count)
    table = table or new_table_name()
    if not hashed:
        rows = rows.repartition(count, "rec_id", BLOCK)
    (
        rows.write.format("parquet")
        .mode(mode)
        .bucketBy(count, "rec_id", BLOCK)
        .sortBy("rec_id", BLOCK, order)
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)


def _allow_buckets(spark: SparkSession, count: int) -> None:
    if count > int(spark.conf.get(MOST_BUCKETS)):
        spark.conf.set(MOST_BUCKETS, str(count))


def open_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, order: str, buckets: int, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """A bucketed table that an earlier application stored, under its layout."""
    _allow_buckets(spark, buckets)
    table = new_table_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (rec_id, {BLOCK}) "
        f"SORTED BY (rec_id, {BLOCK}, {order}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table).withMetadata(BLOCK, {"block_epochs": int(block_epochs)})


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write into the folder has been completed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def layout(epochs: DataFrame, buckets: int) -> DataFrame:
    """Per recording of an epochs table stored in ``buckets``: its extent, and what breaks the layout.

    ``missing`` counts epochs that are not there between 0 and the last; ``misplaced``
    counts rows in another bucket's file than their (rec_id, epoch_block) asks for,
    or whose start is not that of their place.
    """
    file = F.element_at(F.split(F.input_file_name(), "/"), -1)
    bucket = F.regexp_extract(file, r"_(\d+)(?:\.[^/]*)?$", 1).cast("int")
    wrong = (bucket != F.pmod(F.hash("rec_id", BLOCK), F.lit(buckets))) | (
        F.col("start_sec") != F.col("epoch_idx") * EPOCH_SEC
    )
    return epochs.withColumn("_wrong", F.coalesce(wrong, F.lit(True))).groupBy("rec_id").agg(
        F.count(F.lit(1)).alias("n_epochs"),
        F.min("start_sec").alias("first_start_sec"),
        F.max("start_sec").alias("last_start_sec"),
        (F.max("epoch_idx") + 1 - F.count("epoch_idx")).alias("missing"),
        F.count_if("_wrong").alias("misplaced"),
    )


def write_table(rows: DataFrame, path: str) -> DataFrame:
    """Store a table, replacing what the folder held, and return it."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def create_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Empty tables with the declared schemas, in place of what the folder held."""
    return {
        name: write_table(spark.createDataFrame([], schema), f"{root}/{name}")
        for name, schema in TABLES.items()
    }


def _bucketed(epochs: DataFrame, rec_buckets: int) -> DataFrame:
    return epochs.select(
        *EPOCHS.fieldNames(), F.pmod(F.xxhash64("rec_id"), F.lit(rec_buckets)).alias(REC_BUCKET)
    )


def _write_by_bucket(epochs: DataFrame, path: str, rec_buckets: int, block_epochs: int) -> None:
    """Write bucket folders, each as a fixed number of files.

    The blocks of a bucket are dealt over its files, so a long recording is written
    by several tasks, and no task writes small pieces of every bucket.
    """
    session_count = int(epochs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = max(1, session_count // rec_buckets)
    share = F.pmod(F.xxhash64("rec_id", block_of("epoch_idx", block_epochs)), F.lit(files))
    (
        _bucketed(epochs, rec_buckets)
        .repartition(session_count, REC_BUCKET, share)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(REC_BUCKET)
        .parquet(path)
    )


def write_replaceable_epochs(
    epochs: DataFrame, path: str, rec_buckets: int = 64, block_epochs: int = EPOCH_BLOCK
) -> None:
    """Store epochs in folders by recording bucket, the unit that a reload rewrites."""
    _write_by_bucket(epochs, path, rec_buckets, block_epochs)


def reload_epochs(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    rec_buckets: int = 64,
    block_epochs: int = EPOCH_BLOCK,
) -> None:
    """Replace the epochs of the recordings in ``incoming``; run twice, it changes nothing.

    Only the buckets those recordings fall into (at most ``rec_buckets`` numbers)
    are read and overwritten. Spark stages the new files and swaps folders once
    all tasks are done.
    """
    touched = _bucketed(incoming, rec_buckets).select(REC_BUCKET).distinct().collect()
    stored = read_replaceable_epochs(spark, path).filter(
        F.col(REC_BUCKET).isin([row[0] for row in touched])
    )
    merged = replace_epochs(stored, incoming, block_epochs)
    _write_by_bucket(merged, path, rec_buckets, block_epochs)


def read_replaceable_epochs(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*EPOCHS.fields, T.StructField(REC_BUCKET, T.LongType())])
    return spark.read.schema(schema).parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    """Write an export as UTF-8 CSV files with a header each.

    Rows are written by as many tasks as hold them; NULL is an empty field.
    """
    rows.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read an export, with its strings quoted or not."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )
