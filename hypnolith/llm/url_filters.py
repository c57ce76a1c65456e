"""URL filters: a temporal join of captures with dated list entries.

A list entry says that from some day on a host (with all hosts below it) is blocked,
allowed or no longer listed. Entries of one host become validity intervals that do
not overlap; a capture is judged by the entries that are active on the day it was
fetched, the most specific host deciding.

Verdicts are worked out per distinct (host, day), which map-side aggregation leaves
far fewer of than captures, and then joined back on that pair: a host with a third
of all captures is spread over its days, and Spark may split such a pair further.
Neither side is broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, ALLOW, CLEAR = "block", "allow", "clear"

# The first day of captures and the span of days, for tables without dates.
FIRST_DAY = "2024-01-01"
DAYS = 366


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and trailing dot; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)", 1)
    host = F.regexp_extract(authority, r"^(?:.*@)?([^@:]*?)\.?(?::[0-9]*)?$", 1)
    return F.nullif(F.lower(host), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host itself and every parent domain, down to the last label."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """pattern, verdict, valid_from, valid_to (exclusive; null: still active) of dated entries.

    ``entries`` has pattern, verdict (block, allow, clear) and dated. Entries without
    pattern or date count for nothing. Of several entries of one pattern and day,
    block goes before allow, and allow before clear. An interval of ``clear`` lists
    nothing and is left out.
    """
    strength = F.when(F.col("verdict") == BLOCK, 3).when(F.col("verdict") == ALLOW, 2).when(
        F.col("verdict") == CLEAR, 1
    )
    daily = (
        entries.select(F.lower("pattern").alias("pattern"), F.col("dated").cast("date").alias("valid_from"),
                       strength.alias("_strength"))
        .filter("pattern IS NOT NULL AND valid_from IS NOT NULL AND _strength IS NOT NULL")
        .groupBy("pattern", "valid_from")
        .agg(F.max("_strength").alias("_strength"))
    )
    following = F.lead("valid_from").over(Window.partitionBy("pattern").orderBy("valid_from"))
    return (
        daily.withColumn("valid_to", following)
        .filter("_strength > 1")
        .select("pattern", F.when(F.col("_strength") == 3, BLOCK).otherwise(ALLOW).alias("verdict"),
                "valid_from", "valid_to")
    )


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Per capture (page_id, url, fetched): page_id, host, fetched, entry, verdict, kept.

    ``entry`` is the most specific pattern active on the day of the fetch and
    ``verdict`` its word; both are null, and the capture is kept, if none is active
    or if there is no host or day to look up. Every input row gives one row, repeated
    ones too; other columns are ignored. Empty entries keep everything.
    """
    rows = captures.select(
        "page_id", host_of(F.col("url").cast("string")).alias("host"), F.col("fetched").cast("date").alias("fetched")
    )
    keys = rows.filter("host IS NOT NULL AND fetched IS NOT NULL").select("host", "fetched").distinct()
    asked = keys.select("host", "fetched", F.explode(suffixes(F.col("host"))).alias("pattern"))
    active = (F.col("valid_from") <= F.col("fetched")) & (
        F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))
    )
    best = F.max(F.struct(F.length("pattern"), F.col("pattern").alias("entry"), F.col("verdict").alias("verdict")))
    verdicts = (
        asked.join(intervals(entries), "pattern")
        .filter(active)
        .groupBy("host", "fetched")
        .agg(best.alias("_best"))
        .select(F.col("host").alias("_host"), F.col("fetched").alias("_day"), "_best.entry", "_best.verdict")
    )
    same = (F.col("host") == F.col("_host")) & (F.col("fetched") == F.col("_day"))
    return rows.join(verdicts, same, "left").select(
        "page_id", "host", "fetched", "entry", "verdict",
        (F.coalesce(F.col("verdict"), F.lit("")) != BLOCK).alias("kept"),
    )


# --- dates and list entries for a table of pages that has neither ---------------


def _number(text: Column) -> Column:
    """A number below 2 ** 32 from a text's digest."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _day(offset: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), offset.cast("int"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a day of fetch, spread over a year by digest."""
    key = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    return pages.select("page_id", "url", _day(_number(key) % DAYS).alias("fetched"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Dated entries about the hosts and domains of ``pages``, by digest of the name.

    Every fourth host is blocked from some day on, some of those are allowed or
    cleared later; every third of the parent domains is blocked for 120 days.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host IS NOT NULL").distinct()
    number = _number(F.col("host"))
    begin = (number % 300).cast("int")
    entry = lambda verdict, day: F.struct(F.lit(verdict).alias("verdict"), _day(day).alias("dated"))
    none = F.lit(None).cast("struct<verdict:string,dated:date>")
    own = hosts.select(
        F.col("host").alias("pattern"),
        F.array(
            F.when(number % 4 == 0, entry(BLOCK, begin)).otherwise(none),
            F.when((number % 8 == 0), entry(ALLOW, begin + 40)).otherwise(none),
            F.when((number % 12 == 0), entry(CLEAR, begin + 60)).otherwise(none),
        ).alias("_entries"),
    )
    parents = (
        hosts.select(F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("pattern"))
        .filter("pattern <> ''")
        .distinct()
        .withColumn("_n", _number(F.col("pattern")))
        .select(
            "pattern",
            F.array(
                F.when(F.col("_n") % 3 == 0, entry(BLOCK, F.col("_n") % 200)).otherwise(none),
                F.when(F.col("_n") % 3 == 0, entry(CLEAR, F.col("_n") % 200 + 120)).otherwise(none),
            ).alias("_entries"),
        )
    )
    both = own.unionByName(parents)
    return both.select("pattern", F.explode(F.array_compact("_entries")).alias("_e")).select(
        "pattern", "_e.verdict", "_e.dated"
    )


ORACLE = r"""
WITH h AS (SELECT page_id, nullif(lower(regexp_extract(regexp_extract(url,
      '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\]*)', 1), '^(?:.*@)?([^@:]*?)\.?(?::[0-9]*)?$', 1)), '') AS host,
    DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 366 AS INTEGER)
      AS fetched FROM pages),
u AS (SELECT DISTINCT host, CAST('0x' || substr(md5(host), 1, 8) AS BIGINT) AS n FROM h WHERE host IS NOT NULL),
q AS (SELECT DISTINCT regexp_extract(host, '^[^.]+\.(.+)$', 1) AS pattern FROM u),
v AS (SELECT pattern, CAST('0x' || substr(md5(pattern), 1, 8) AS BIGINT) AS n FROM q WHERE pattern <> ''),
e AS (
  SELECT host AS pattern, 'block' AS verdict, n % 300 AS day FROM u WHERE n % 4 = 0
  UNION ALL SELECT host, 'allow', n % 300 + 40 FROM u WHERE n % 8 = 0
  UNION ALL SELECT host, 'clear', n % 300 + 60 FROM u WHERE n % 12 = 0
  UNION ALL SELECT pattern, 'block', n % 200 FROM v WHERE n % 3 = 0
  UNION ALL SELECT pattern, 'clear', n % 200 + 120 FROM v WHERE n % 3 = 0),
g AS (SELECT pattern, day, max(CASE verdict WHEN 'block' THEN 3 WHEN 'allow' THEN 2 ELSE 1 END) AS s
  FROM e GROUP BY pattern, day),
x AS (SELECT h.page_id, h.host, h.fetched, g.pattern, g.s, row_number() OVER (
      PARTITION BY h.page_id, g.pattern ORDER BY g.day DESC) AS recent
  FROM h JOIN g ON (h.host = g.pattern OR ends_with(h.host, '.' || g.pattern))
    AND DATE '2024-01-01' + CAST(g.day AS INTEGER) <= h.fetched),
b AS (SELECT page_id, pattern, s, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC) AS k
  FROM x WHERE recent = 1 AND s > 1)
SELECT h.page_id, h.host, CAST(h.fetched AS VARCHAR) AS fetched, b.pattern AS entry,
  CASE b.s WHEN 3 THEN 'block' WHEN 2 THEN 'allow' END AS verdict, coalesce(b.s, 0) <> 3 AS kept
FROM h LEFT JOIN b ON h.page_id = b.page_id AND b.k = 1
"""
