"""A summary of stored epochs per recording, block and file, kept beside the table.

It has one row per recording and block (2^18 epochs), and answers two kinds of question
without a scan of epochs: which files hold a recording, and how many epochs of each
stage there are. Counts are believed only if the files it names are the ones in the
table's folder, with the same lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hypnolith.functions.keys import BLOCK
from hypnolith.schemas import EPOCHS, STAGES
from hypnolith.sources.storage import write_table

#: Recordings of one lookup, and files that one lookup opens by name; more are a scan.
MOST_RECORDINGS = 1000
MOST_FILES = 10_000


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def write_block_index(epochs: DataFrame, path: str) -> DataFrame:
    """Summarise a stored epochs table, and return the stored summary.

    Epochs are grouped where they lie. The summary is in order of rec_id, so that a
    lookup reads one of its row groups.
    """
    label = F.col("stage_label")
    known = [F.count_if(label == stage).alias(f"n_{stage}") for stage in STAGES]
    summary = (
        epochs.select("rec_id", BLOCK, "epoch_idx", "stage_label", "_metadata.file_path", "_metadata.file_size")
        .groupBy("rec_id", BLOCK, "file_path", "file_size")
        .agg(
            F.count(F.lit(1)).alias("n_epochs"),
            F.min("epoch_idx").alias("first_epoch"),
            F.max("epoch_idx").alias("last_epoch"),
            *known,
            F.count_if(label.isNull() | ~label.isin(*STAGES)).alias("n_other"),
        )
    )
    return write_table(summary.repartitionByRange("rec_id").sortWithinPartitions("rec_id", BLOCK), path)


def recording_epochs(
    epochs: DataFrame,
    index: DataFrame,
    rec_ids: list[int],
    first_epoch: int | None = None,
    last_epoch: int | None = None,
) -> DataFrame:
    """Epochs of some recordings, or a stretch of them, from the files that hold them.

    Only those files are opened, and inside them the row groups whose rec_id range
    matches. More than MOST_RECORDINGS ids are refused; if they lie in more than
    MOST_FILES files the whole table is filtered instead. ``epochs`` is the table that
    ``index`` describes.
    """
    if len(rec_ids) > MOST_RECORDINGS:
        raise ValueError(f"a lookup takes at most {MOST_RECORDINGS} recordings; join with larger sets")
    wanted, rows = F.col("rec_id").isin(rec_ids), F.lit(True)
    held = index.filter(wanted)
    if first_epoch is not None:
        held, rows = held.filter(F.col("last_epoch") >= first_epoch), rows & (F.col("epoch_idx") >= first_epoch)
    if last_epoch is not None:
        held, rows = held.filter(F.col("first_epoch") <= last_epoch), rows & (F.col("epoch_idx") <= last_epoch)
    files = [r.file_path for r in held.select("file_path").distinct().limit(MOST_FILES + 1).collect()]
    spark = epochs.sparkSession
    if len(files) > MOST_FILES:
        found = epochs
    elif files:
        found = spark.read.schema(T.StructType([*EPOCHS.fields, epochs.schema[BLOCK]])).parquet(*files)
    else:
        found = epochs.limit(0)
    return found.filter(wanted & rows).select(*EPOCHS.fieldNames())


def longest_recording(index: DataFrame) -> list[int]:
    """The id of the recording with most epochs (of several, the least), if there is one."""
    size = index.groupBy("rec_id").agg(F.sum("n_epochs").alias("n")).orderBy(F.desc("n"), "rec_id").limit(1)
    return [r.rec_id for r in size.collect()]


def describes(index: DataFrame, folder: str) -> bool:
    """Whether the summary names exactly the files of the table's folder, at their lengths.

    Only the folder's listing is read, by Spark; file contents are pruned.
    """
    named = index.select(_name(F.col("file_path")).alias("file"), F.col("file_size").alias("named")).distinct()
    listed = (
        index.sparkSession.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select(_name(F.col("path")).alias("file"), F.col("length").alias("listed"))
    )
    differ = named.join(listed, "file", "full_outer").filter(~F.col("named").eqNullSafe(F.col("listed")))
    return differ.isEmpty()


def stage_epochs(index: DataFrame, epochs: DataFrame, folder: str) -> DataFrame:
    """stage_label and its number of epochs: from the summary if it can be believed, else by a scan.

    Files without rows are not in the summary and cannot be told from unknown ones, so a
    table with such files, or with labels outside the vocabulary, is scanned.
    """
    if describes(index, folder) and index.filter("n_other > 0").isEmpty():
        totals = index.agg(*[F.sum(f"n_{s}").alias(s) for s in STAGES])
        pairs = F.array(*[F.struct(F.lit(s).alias("stage_label"), F.col(s).alias("n_epochs")) for s in STAGES])
        return totals.select(F.inline(pairs)).filter("n_epochs > 0")
    return epochs.groupBy("stage_label").agg(F.count(F.lit(1)).alias("n_epochs"))

