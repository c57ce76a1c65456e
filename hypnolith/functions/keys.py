"""Ways to keep one huge key from landing in one task.

* Epochs are cut into fixed-length *blocks* of a recording. ``(rec_id,
  epoch_block)`` is the partitioning of every per-epoch join, window and
  de-duplication, so a group holds at most ``EPOCH_BLOCK`` epochs however long
  the recording is; what crosses a block edge is stitched on block summaries,
  which are smaller by that factor.
* Rows that have no such natural cut are joined to per-key values on
  ``(key, salt)``.
* New surrogate ids are dense but numbered in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH_BLOCK = 1 << 18
BLOCK = "epoch_block"
SALTS = 16


def block_of(index: str, block_epochs: int) -> Column:
    return F.expr(f"{index} div {int(block_epochs)}")


def as_block(column: Column, block_epochs: int) -> Column:
    """The column named as the epochs' block, with the block length in its metadata."""
    return column.alias(BLOCK, metadata={"block_epochs": int(block_epochs)})


def with_block(epochs: DataFrame, block_epochs: int = EPOCH_BLOCK) -> DataFrame:
    """Epochs with their block; a stored block column of that length is kept.

    Keeping the column object matters: Spark then knows that the rows are
    already hashed on it and adds no further exchange. A block column of another
    length is replaced.
    """
    others = [c for c in epochs.columns if c != BLOCK]
    if len(others) < len(epochs.columns):
        if epochs.schema[BLOCK].metadata.get("block_epochs") == block_epochs:
            return epochs
    return epochs.select(*others, as_block(block_of("epoch_idx", block_epochs), block_epochs))


def spread_over_blocks(
    rows: DataFrame, first: str, last: str, block_epochs: int = EPOCH_BLOCK
) -> DataFrame:
    """One copy of each row per block that its [first, last] epoch range touches."""
    blocks = F.sequence(block_of(first, block_epochs), block_of(last, block_epochs))
    return rows.filter(F.col(last) >= F.col(first)).withColumn(BLOCK, F.explode(blocks))


def lookup_by_salted_key(
    rows: DataFrame, per_key: DataFrame, key: str, spread: str
) -> DataFrame:
    """Inner join of many rows to one value row per key, for keys of any size.

    ``spread`` is an integer column that differs within a key; it deals the rows
    of one key over ``SALTS`` join groups. Both join inputs are plain shuffles,
    the shape that adaptive skew splitting can cut further.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread)), F.lit(SALTS)))
    salts = F.array(*[F.lit(s).cast("long") for s in range(SALTS)])
    copies = per_key.withColumn("_salt", F.explode(salts))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def with_dense_ids(
    rows: DataFrame, keys: list[str], id_column: str, after: Column
) -> DataFrame:
    """Number rows with distinct ``keys`` densely from ``after + 1``.

    The order is that of (first 4 hex digits of md5(keys), keys). The 65,536
    digest prefixes hold near-equal shares of distinct keys, so each is numbered
    on its own and shifted by the size of the prefixes before it.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    marked = rows.withColumn("_prefix", F.substring(F.md5(text), 1, 4))
    sizes = marked.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_prefix", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    inside = F.row_number().over(Window.partitionBy("_prefix").orderBy(*keys))
    return (
        marked.withColumn("_rank", inside)
        .join(shifts, "_prefix")
        .withColumn(id_column, (after + F.col("_shift") + F.col("_rank")).cast("long"))
        .drop("_prefix", "_rank", "_shift")
    )
