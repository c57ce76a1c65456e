"""Bucketed epochs that reloads replace without rewriting them: merge on read.

A reload appends the new epochs to the table as further files of its buckets, under a
version of its own, and then commits one small table that says, per recording and block,
which version counts from now on. Blocks that a recording no longer has are listed too
and so disappear. Readers look versions up in place, on the columns the table is bucketed
by: epochs are neither shuffled nor rewritten. Until its version table is committed,
nothing of a reload can be seen, also not of one that failed half way.

:func:`compact` writes what can be seen into one sorted file per bucket again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypnolith.functions.keys import BLOCK, EPOCH_BLOCK, as_block, with_block
from hypnolith.schemas import EPOCHS
from hypnolith.sources.storage import is_committed, new_table_name, write_bucketed

BASE = "base"


@dataclass(frozen=True)
class VersionedEpochs:
    """A bucketed epochs table and the folder of its version tables."""

    spark: SparkSession
    table: str
    root: str
    buckets: int
    block_epochs: int = EPOCH_BLOCK

    def _append(self, epochs: DataFrame, version: str, mode: str) -> None:
        rows = with_block(epochs.select(*EPOCHS.fieldNames()), self.block_epochs)
        rows = rows.select(
            *EPOCHS.fieldNames(), as_block(F.col(BLOCK), self.block_epochs), F.lit(version).alias("version")
        )
        write_bucketed(rows, f"{self.root}/epochs", "epoch_idx", self.buckets, table=self.table, mode=mode)

    def _committed(self) -> list[str]:
        """Version tables of completed reloads, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = sorted(s.getPath().getName() for s in files.listStatus(path))
        return [n for n in names if is_committed(self.spark, f"{self.root}/versions/{n}")]

    def read(self) -> DataFrame:
        """Epochs (and their block) as of the last completed reload."""
        rows = self.spark.table(self.table)
        names = self._committed()
        current = F.lit(BASE)
        if names:
            listed = self.spark.read.parquet(*[f"{self.root}/versions/{n}" for n in names])
            live = listed.groupBy("rec_id", BLOCK).agg(F.max(F.struct("number", "version")).alias("live"))
            rows = rows.join(live.hint("shuffle_hash"), ["rec_id", BLOCK], "left")
            current = F.coalesce(F.col("live.version"), F.lit(BASE))
        return rows.filter(F.col("version") == current).select(*EPOCHS.fieldNames(), BLOCK)

    def reload(self, incoming: DataFrame, blocks: DataFrame | None = None) -> None:
        """Replace the epochs of every recording in ``incoming``; others stay as they are.

        With ``blocks`` (rec_id and block, distinct) just those are replaced: by their epochs in
        ``incoming``, or by none.
        """
        names = self._committed()
        version = uuid.uuid4().hex
        number = 1 + (int(names[-1].split("-")[0]) if names else 0)
        self._append(incoming, version, "append")
        if blocks is None:
            table = self.spark.table(self.table)
            replaced = table.filter(F.col("version") == version).select("rec_id").distinct()
            # One row per recording and block: those of before, and the new ones.
            blocks = table.select("rec_id", BLOCK).distinct().join(replaced, "rec_id", "left_semi")
        entries = blocks.select("rec_id", BLOCK, F.lit(number).alias("number"), F.lit(version).alias("version"))
        entries.write.parquet(f"{self.root}/versions/{number:08d}-{version}")

    def compact(self, root: str) -> VersionedEpochs:
        """What can be seen, as a new table under ``root`` with one file per bucket."""
        return create_versioned(self.read(), root, self.buckets, self.block_epochs)


def create_versioned(
    epochs: DataFrame, root: str, buckets: int | None = None, block_epochs: int = EPOCH_BLOCK
) -> VersionedEpochs:
    """Store epochs as the first version of a table under the empty folder ``root``."""
    spark = epochs.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = VersionedEpochs(spark, new_table_name(), root, count, block_epochs)
    stored._append(epochs, BASE, "overwrite")
    return stored
