"""What the operators share on Spark's side: inputs, written tables, native word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hypnolith.session import working_folder

#: [^\x20\x09-\x0D]+ is a word.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Rows and bytes of one Arrow batch, so that Python memory does not grow with long texts.
BATCH_ROWS = 2000
BATCH_BYTES = 1 << 20


# So many document ids are sent to all executors (16 MB); more are joined by a shuffle.
BROADCAST_IDS = 1 << 20

#: Doc ids compare as longs; rows without one come after all others.
LAST_ID = (1 << 63) - 1


def ordered_id(docs: DataFrame) -> Column:
    """doc_id as a long; a missing one comes last."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def rows_with_ids(rows: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose doc_id (all columns of ``ids``) is, or with ``left_anti`` is not, among the distinct ``ids``.

    Few ids are broadcast, after they have been counted, so that the rows stay where
    they are.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, ids.columns, how)


def with_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the shared working folder and read them back: the lineage ends there."""
    spark = rows.sparkSession
    path = working_folder(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Array of the words of a text; none for null."""
    return F.filter(
        F.split(F.coalesce(text, F.lit("")), SPACES), lambda word: word != F.lit("")
    )


def computed(rows: DataFrame, keep: list[Column], **values: Column) -> DataFrame:
    """``keep`` and further columns that are worked out once per row.

    They come from a generator of one row, which the optimizer moves no expression
    through: a later filter or lambda refers to the value and does not repeat it.
    """
    struct = F.struct(*[value.alias(name) for name, value in values.items()])
    return rows.select(*keep, F.inline(F.array(struct)))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)
