"""Snapshots of all tables of a mart: a load or a delete shows fully or not at all.

A commit writes changed tables into a folder of its own and then a manifest that names
the folder of every table. The manifest is written beside its place and moved there by
one rename; the highest numbered one is the current snapshot. Whatever fails before the
rename leaves the snapshot before it as it was. Readers keep the folders of the manifest
they have read, whatever is committed meanwhile. Two commits on one snapshot cannot both
succeed: the second finds its number taken.

:meth:`Snapshots.expire` removes folders that no kept manifest names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hypnolith.functions.keys import BLOCK, EPOCH_BLOCK
from hypnolith.operators.quality import cascade_delete
from hypnolith.schemas import EPOCHS, TABLES
from hypnolith.sources.storage import open_bucketed, write_epochs, write_table

_EPOCHS = T.StructType([*EPOCHS.fields, T.StructField(BLOCK, T.LongType())])


class SnapshotConflict(RuntimeError):
    """Another commit has been made since this one's snapshot was read."""


@dataclass(frozen=True)
class Snapshots:
    """The snapshots under a folder that the driver and all executors share."""

    spark: SparkSession
    root: str

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Numbers of the committed snapshots, ascending."""
        path, files = self._path("snapshots")
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, number: int) -> dict[str, dict]:
        """Folder (and, of epochs, buckets) of every table of a snapshot."""
        lines = self.spark.read.text("/".join((self.root, "snapshots", f"{number:08d}.json"))).collect()
        return json.loads("".join(line.value for line in lines))

    def read(self, number: int | None = None) -> dict[str, DataFrame]:
        """The tables of a snapshot, the current one unless a number is given."""
        number = self.numbers()[-1] if number is None else number
        return {name: self._opened(name, kept) for name, kept in self.manifest(number).items()}

    def _opened(self, name: str, kept: dict) -> DataFrame:
        if name == "epochs":
            return open_bucketed(self.spark, kept["path"], _EPOCHS, "epoch_idx", kept["buckets"], kept["block_epochs"])
        return self.spark.read.schema(TABLES[name]).parquet(kept["path"])

    def commit(
        self, tables: dict[str, DataFrame], base: int | None = None, buckets: int | None = None, block_epochs: int = EPOCH_BLOCK
    ) -> int:
        """Store ``tables`` as the snapshot after ``base`` and return its number.

        Tables that are not given are those of ``base`` (the current snapshot unless
        given, none for the first). Fails with :class:`SnapshotConflict`, having changed
        nothing that can be seen, if another snapshot has followed ``base``.
        """
        numbers = self.numbers()
        base = base if base is not None else (numbers[-1] if numbers else 0)
        named = self.manifest(base) if base else {}
        folder = f"data/{base + 1:08d}-{uuid.uuid4().hex}"
        for name, rows in tables.items():
            path = f"{self.root}/{folder}/{name}"
            named[name] = {"path": path}
            if name == "epochs":
                count = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                write_epochs(rows, path, count, block_epochs)
                named[name] |= {"buckets": count, "block_epochs": block_epochs}
            else:
                write_table(rows.select(*TABLES[name].fieldNames()), path)
        missing = set(TABLES) - set(named)
        if missing:
            raise ValueError(f"the first snapshot needs all tables; missing: {sorted(missing)}")
        self._publish(named, base + 1)
        return base + 1

    def _publish(self, named: dict[str, dict], number: int) -> None:
        written, files = self._path("snapshots", f".{uuid.uuid4().hex}")
        target, _ = self._path("snapshots", f"{number:08d}.json")
        stream = files.create(written)
        stream.write(bytearray(json.dumps(named).encode()))
        stream.close()
        if files.exists(target) or not files.rename(written, target):
            files.delete(written, False)
            raise SnapshotConflict(f"snapshot {number} has been committed by another writer")

    def delete_patients(self, deleted: DataFrame) -> int:
        """Commit the tables without some patients (patients_id) and all that belongs to them."""
        number = self.numbers()[-1]
        kept = self.manifest(number)["epochs"]
        tables = cascade_delete(self.read(number), deleted)
        return self.commit(tables, number, kept["buckets"], kept["block_epochs"])

    def expire(self, keep: int = 1) -> list[str]:
        """Drop all but the last ``keep`` snapshots and every folder that none of those names.

        To be run when no commit is under way and no reader needs the older ones.
        """
        if keep < 1:
            raise ValueError("the current snapshot is kept")
        numbers = self.numbers()
        for number in numbers[:-keep]:
            path, files = self._path("snapshots", f"{number:08d}.json")
            files.delete(path, False)
        named = {kept["path"] for number in numbers[-keep:] for kept in self.manifest(number).values()}
        data, files = self._path("data")
        removed = []
        for folder in files.listStatus(data) if files.exists(data) else []:
            commit = folder.getPath().getName()
            for table in files.listStatus(folder.getPath()):
                name = table.getPath().getName()
                if f"{self.root}/data/{commit}/{name}" not in named:
                    files.delete(table.getPath(), True)
                    removed.append(f"{commit}/{name}")
        return removed
