"""Recording files under a root folder, listed and dated by executors.

The driver lists nothing: one task lists the root, its sub-folders are dealt over tasks
that list them in turn, and files are dealt anew before their headers are read. Of a
recording only the first 256 bytes are read, the fixed part of its header, which hold
the start as ``dd.mm.yy`` and ``hh.mm.ss`` and, in newer files, a four-digit year. This
source runs Python in its tasks: Spark's own readers would read whole files for that.
Paths are local ones or URIs that pyarrow's file systems open.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypnolith.sources.folder import HYPNOGRAM_ENDING, PSG_ENDING

HEADER_BYTES = 256
LISTED = "path string, folder string, name string, is_folder boolean, modified timestamp"
MANIFEST = "folder string, name string, meas_date timestamp, modified timestamp"

# Places of the header's fields, and the month names of its four-digit date.
_RECORDING, _DATE, _TIME = slice(88, 168), slice(168, 176), slice(176, 184)
_MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
_LONG_DATE = re.compile(r"Startdate (\d\d)-([A-Z]{3})-(\d{4})")
#: Two-digit years from here on are of the last century.
_CENTURY_FROM = 85


def start_of_header(header: bytes) -> datetime | None:
    """Start of a recording by its header, in UTC; None if it is damaged or states none."""
    text = header[:HEADER_BYTES].decode("latin-1")
    try:
        day, month, year = (int(x) if x.isdigit() else None for x in text[_DATE].split("."))
        hour, minute, second = map(int, text[_TIME].split("."))
        long_ = _LONG_DATE.match(text[_RECORDING].upper().replace("STARTDATE", "Startdate"))
        if long_ and long_[2] in _MONTHS:
            day, month, year = int(long_[1]), _MONTHS.index(long_[2]) + 1, int(long_[3])
        else:
            year += 1900 if year >= _CENTURY_FROM else 2000
        return datetime(year, month, day, hour, minute, second, tzinfo=timezone.utc)
    except (ValueError, TypeError):
        return None


def _opened(root: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """(file system, the root's path in it); paths of listed files are paths in it as well."""
    if root.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    if "://" in root:
        return pyarrow.fs.FileSystem.from_uri(root)
    return pyarrow.fs.LocalFileSystem(), root


def _listing(recursive: bool, root: str):
    """Folders -> what they hold; with ``recursive`` the files in all their sub-folders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(root)
        base = base.rstrip("/")
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = files.get_file_info(pyarrow.fs.FileSelector(path or base, recursive=recursive))
                rows = []
                for info in found:
                    is_folder = info.type == pyarrow.fs.FileType.Directory
                    if not (is_folder and recursive):
                        parent = info.path[: -len(info.base_name)].rstrip("/")
                        folder = parent[len(base) :].strip("/") or None
                        rows.append((info.path, folder, info.base_name, is_folder, info.mtime))
                for k in range(0, len(rows), 10_000):
                    part = list(zip(*rows[k : k + 10_000]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(part, _LISTED_TYPES)], names=_LISTED_NAMES
                    )

    return run


_LISTED_NAMES = [c.split()[0] for c in LISTED.split(", ")]
_LISTED_TYPES = [pa.string()] * 3 + [pa.bool_(), pa.timestamp("us", "UTC")]


def _dated(root: str):
    """Listed files -> the same with the start of each recording."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _opened(root)
        for batch in batches:
            starts = []
            for path, name in zip(batch.column("path").to_pylist(), batch.column("name").to_pylist()):
                start = None
                if name.endswith(PSG_ENDING):
                    with files.open_input_stream(path) as stream:
                        start = start_of_header(stream.read(HEADER_BYTES))
                starts.append(start)
            dated = pa.array(starts, pa.timestamp("us", "UTC"))
            columns = [batch.column("folder"), batch.column("name"), dated, batch.column("modified")]
            yield pa.RecordBatch.from_arrays(columns, names=["folder", "name", "meas_date", "modified"])

    return run


def scan_recordings(spark: SparkSession, root: str) -> DataFrame:
    """folder (below ``root``; NULL in it), name, meas_date and modified of all recording files."""
    top = spark.createDataFrame([("",)], "path string").mapInArrow(_listing(False, root), LISTED)
    inner = top.filter("is_folder").repartition("path").select("path").mapInArrow(_listing(True, root), LISTED)
    files = top.filter("NOT is_folder").unionByName(inner)
    files = files.filter(F.col("name").endswith(PSG_ENDING) | F.col("name").endswith(HYPNOGRAM_ENDING))
    return files.repartition("path").mapInArrow(_dated(root), MANIFEST)
