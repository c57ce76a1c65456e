"""Mixing sources to target weights by capped water-filling.

Every source has a weight. All weights share a budget of words; a source whose
share would exceed ``max_epochs`` times its size is clamped there, and the excess
goes to the others in proportion to their weights, again and again until none is
above. That process ends at one water level: target = min(cap, weight * level).
With sources in order of cap / weight, the level follows from running sums of caps
and weights, so no round is run on the data.

A target is met by whole repetitions of all documents and one more repetition of
the first documents in a seeded order, up to the words that are missing. Only one
cut-off key per source is needed to decide that, so documents are not sorted or
shuffled: the order's digest buckets are summed, and only the bucket with the
cut-off is looked into. The order is by a digest of id and text, so that rows without id
and rows that repeat one are spread like all others. Rows equal in both share a key;
if that is the cut-off, a stated number of them is taken, numbered in the parts they
are stored in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hypnolith.llm.tables import WORD, stored

MAX_EPOCHS = 3
SEED = "mix-1"
# Digest digits of a bucket: 4,096 buckets per source.
BUCKET_DIGITS = 3
SALTS = 64
# Some 10 MB of shares.
BROADCAST_SOURCES = 1 << 17


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Place of a document in the seeded order: a digest of seed, id and text."""
    of = [F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text.cast("string"), F.lit("")))]
    return F.md5(F.concat(F.lit(f"{seed}:"), *of))


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights that repeat over the sources in code-point order, null last.

    ``sources`` has one row per source; only that table is ranked as a whole.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    return sources.withColumn("weight", F.get(cycle, F.pmod(rank, F.lit(len(weights)))).cast("long"))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS, budget: Column | None = None) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size, weight).

    The budget is the words of all sources unless given; beyond ``max_epochs`` times
    all words every source stays at its cap.
    """
    everything = Window.partitionBy()
    cap = F.col("source_size") * max_epochs
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = budget if budget is not None else F.sum("source_size").over(everything)
    leveled = (
        sources.withColumn("_cap", cap)
        .withColumn("_ratio", F.col("_cap") / F.col("weight"))
        .withColumn(
            "_level",
            (total - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double")
            / F.sum("weight").over(after),
        )
    )
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything)
    capped = F.col("_cap").cast("double")
    return (
        leveled.withColumn("_water", level)
        .withColumn("target", F.coalesce(F.least(capped, F.col("weight") * F.col("_water")), capped))
        .drop("_cap", "_ratio", "_level", "_water")
    )


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size and place in the seeded order of every document."""
    doc_id = F.col("doc_id")
    return docs.select(
        doc_id, F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
        order_key(doc_id, F.col("text"), seed).alias("_key"),
    )


def shares(sizes: DataFrame, weigh=cyclic_weights, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: source_size, weight, target, whole repetitions and the cut-off key.

    A document is taken ``whole`` times, and once more if its key is at most ``cut``:
    that is, if its middle word comes before the missing words in the seeded order.
    Where only some of the rows with the key ``cut`` are, ``cut_rows`` says how many.
    """
    buckets = (
        sizes.groupBy("source", F.substring("_key", 1, BUCKET_DIGITS).alias("_bucket"))
        .agg(F.sum("size").alias("_words"))
        .withColumn("_bucket_source", F.col("source"))
    )
    sources = buckets.groupBy("source").agg(F.sum("_words").alias("source_size"))
    goals = targets(weigh(sources), max_epochs)
    size = F.col("source_size")
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("int")
    goals = goals.withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * size)
    upto = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    goal = goals.select(F.col("source").alias("_goal"), "extra")
    edge = (
        buckets.drop("_bucket_source")
        .withColumn("_before", F.coalesce(F.sum("_words").over(upto), F.lit(0)))
        .join(goal, F.col("source").eqNullSafe(F.col("_goal")))
        .filter("_before <= extra AND extra < _before + _words")
        .select(F.col("_goal").alias("_edge_source"), F.col("_bucket").alias("_edge"), "_before", "extra")
    )
    inside = sizes.join(
        edge,
        F.col("source").eqNullSafe(F.col("_edge_source"))
        & (F.substring("_key", 1, BUCKET_DIGITS) == F.col("_edge")),
    )
    # Rows with one key are equal and have one size; they take part as one row.
    alike = inside.groupBy("source", "_key", "_edge", "_before", "extra").agg(F.count("*").alias("_rows"), F.max("size").alias("_size"))
    running = Window.partitionBy("source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("extra") - F.col("_before") - F.coalesce(F.sum(F.col("_size") * F.col("_rows")).over(running), F.lit(0))
    # The k-th of them is taken if its middle, (k - 1/2) sizes on, comes before the missing words end.
    some = F.when(F.col("_size") > 0, F.ceil(F.col("_missing") / F.col("_size") + 0.5) - 1).otherwise(
        F.when(F.col("_missing") > 0, F.col("_rows")).otherwise(0)
    )
    taken = F.least(F.col("_rows"), F.greatest(F.lit(0), some))
    last = F.max(F.when(F.col("_taken") > 0, F.struct("_key", "_taken", "_rows")))
    cuts = (
        alike.withColumn("_missing", missing)
        .withColumn("_taken", taken)
        .groupBy("source")
        .agg(last.alias("_last"), F.min("_edge").alias("_edge"))
        .select(
            F.col("source").alias("_cut_source"),
            F.coalesce("_last._key", "_edge").alias("cut"),
            F.when(F.col("_last._taken") < F.col("_last._rows"), F.col("_last._taken")).alias("cut_rows"),
        )
    )
    return goals.join(cuts, F.col("source").eqNullSafe(F.col("_cut_source")), "left").select(
        F.col("source").alias("share_source"), "source_size", "weight", "target", "whole", "cut", "cut_rows"
    )


def with_share(rows: DataFrame, share: DataFrame, source: str) -> DataFrame:
    """Rows (with ``_key``) joined with their source's share, and ``times`` they are taken.

    Shares are one row per source. They are counted, and sent to all executors if they
    are few. Else a source with very many documents is dealt over ``SALTS`` groups by
    the digest, and the shares are repeated for those.
    """
    share = stored(share, "mix-shares")
    same = F.col(source).eqNullSafe(F.col("share_source"))
    if share.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(share), same, "left")
    else:
        salted = rows.withColumn("_salt", F.pmod(F.hash("_key"), F.lit(SALTS)))
        copies = share.withColumn("_share_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, same & (F.col("_salt") == F.col("_share_salt")), "left")
    more = lambda test: joined.withColumn("times", F.col("whole") + F.when(test, 1).otherwise(0))
    if share.filter("cut_rows IS NOT NULL").isEmpty():
        return more(F.col("_key") <= F.col("cut"))
    at_cut = F.coalesce((F.col("_key") == F.col("cut")) & F.col("cut_rows").isNotNull(), F.lit(False))
    # Equal rows at the cut are numbered in the parts they are written in, after the parts before.
    tied = stored(joined.filter(at_cut).withColumn("_part", F.spark_partition_id()), "mix-tied")
    parts = tied.groupBy("share_source", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("share_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("share_source").alias("_of"), F.col("_part").alias("_number"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead")
    )
    inside = F.row_number().over(Window.partitionBy("share_source", "_part").orderBy("_key"))
    placed = tied.withColumn("_row_number", inside).join(
        parts, F.col("share_source").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_number"))
    )
    taken = F.col("_ahead") + F.col("_row_number") <= F.col("cut_rows")
    tied = placed.withColumn("times", F.col("whole") + F.when(taken, 1).otherwise(0))
    rest = more(F.col("_key") <= F.col("cut")).filter(~at_cut)
    return rest.unionByName(tied.select(*rest.columns))


def mix(docs: DataFrame, seed: str = SEED, weigh=cyclic_weights, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's) and taken (words).

    A null text has no words; null is a source of its own. Rows without doc_id, and rows
    that repeat one, are documents like all others; of rows equal in id, source and text
    any may be the ones that are taken. A source is off its target by at most half of
    one document. Sources without words have target 0. No row is lost; an empty table
    gives an empty result.
    """
    sizes = stored(sized(docs, seed), "mix")
    share = shares(sizes, weigh, max_epochs)
    return with_share(sizes, share, "source").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, seed: str = SEED, weigh=cyclic_weights, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    sizes = stored(sized(docs, seed), "mix")
    share = shares(sizes, weigh, max_epochs)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("source").cast("string").alias("_source"),
        order_key(F.col("doc_id"), F.col("text"), seed).alias("_key"),
    )
    joined = with_share(rows, share, "_source").filter("times > 0")
    return joined.select("_row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_copy")).select("_row.*")


ORACLE = r"""
WITH s AS (
  SELECT doc_id, source, md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', md5(coalesce(text, '')))) AS k,
    CASE WHEN text IS NULL THEN 0 ELSE
      len(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS size
  FROM documents),
g AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1 AS weight FROM g),
r AS (SELECT *, 3 * source_size AS cap, (3 * source_size) / weight AS ratio,
    sum(source_size) OVER () AS total FROM w),
l AS (SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE),
      weight * max(CASE WHEN level <= ratio THEN level END) OVER ()), CAST(cap AS DOUBLE)) AS target FROM l),
d AS (SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size / 2 AS middle
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (whole + CASE WHEN middle < target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d
"""
