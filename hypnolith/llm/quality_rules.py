"""Quality rules: a table of thresholds compiled into one Spark projection.

Measures are built from arrays of a text's words and lines with Spark's own
functions; every rule bounds one measure. Nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import WORD, bound, computed, words_of

WINDOW = 5
# Words that a text must have for its share of stop words to count.
STOP_WORDS_FROM = 50

# Frequent function words of the languages that are served.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at are from "
    "de la le les et un une des que en el los las y del se por con para der die und den das ist ein zu"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``least`` and ``most`` where they are given.

    A measure that is null (a ratio over nothing) breaks no rule.
    """

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        value = F.col(self.measure)
        bounds = [value < self.least] if self.least is not None else []
        bounds += [value > self.most] if self.most is not None else []
        test = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
        return F.coalesce(test, F.lit(False))


#: The rules of the production run. They are wide: a document of ordinary prose,
#: in whatever language, breaks none of them.
RULES = (
    Rule("short_words", "mean_word_chars", least=1.5),
    Rule("long_words", "mean_word_chars", most=20.0),
    Rule("symbols", "symbol_ratio", most=0.25),
    Rule("stop_words", "stop_word_ratio", least=0.01),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that the text holds twice or more.

    Windows are compared as text. Only where two are equal are they sorted, to find
    the places of equal ones; a place then counts the words up to the next one.
    """
    places = F.sequence(F.lit(0), F.size(words) - WINDOW)

    def window(at: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, at + k) for k in range(WINDOW)])

    def count(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda w, at: F.struct(w.alias("w"), at.alias("at"))))

        def equal_places(order: Column) -> Column:
            def place(item: Column, k: Column) -> Column:
                same = (F.get(order, k - 1)["w"] == item["w"]) | (F.get(order, k + 1)["w"] == item["w"])
                return F.when(same, item["at"])

            return F.sort_array(F.filter(F.transform(order, place), lambda p: p.isNotNull()))

        def covered(found: Column) -> Column:
            step = lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(found, k + 1) - p, F.lit(WINDOW)))
            return F.aggregate(F.transform(found, step), F.lit(0), lambda total, x: total + x)

        repeated = bound(bound(ranked, equal_places), covered)
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), repeated).otherwise(0)

    return F.when(F.size(words) > WINDOW, bound(F.transform(places, window), count)).otherwise(0)


def measures(rows: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and the measures of the whole text in column ``_text``."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    split = computed(
        rows,
        [*keep, F.col("_text")],
        _words=words_of(F.col("_text")),
        _lines=F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
    )
    words, lines = F.col("_words"), F.col("_lines")
    n, n_lines = F.size(words), F.size(lines)
    spaces, symbols = " \t\n\x0b\f\r", "#*$%&|<>"
    stops = F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))
    return computed(
        split,
        keep,
        n_words=n.cast("long"),
        word_chars=F.length(F.translate(text, spaces, "")).cast("long"),
        n_symbols=(F.length(text) - F.length(F.translate(text, symbols, ""))).cast("long"),
        n_dup_lines=(n_lines - F.size(F.array_distinct(lines))).cast("long"),
        n_repeat_words=_repeat_words(words).cast("long"),
        n_lines=n_lines.cast("long"),
        n_stop_words=F.size(stops).cast("long"),
    )


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "stop_word_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def _verdict(rows: DataFrame, keep: list[Column], rules: tuple[Rule, ...]) -> DataFrame:
    """``keep`` columns with measures, ratios, base_failed, broken and kept."""
    rows = measures(rows, keep)
    rows = rows.withColumns({k: F.try_divide(F.col(a), F.col(b)) for k, (a, b) in RATIOS.items()})
    # A short text may well have no function word.
    long_ = F.col("n_words") >= STOP_WORDS_FROM
    rows = rows.withColumn("stop_word_ratio", F.when(long_, F.col("stop_word_ratio")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.name)) for r in rules]))
    rows = rows.withColumn("base_failed", failed).withColumn("broken", broken)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, the measures, base_failed, broken (rule names), kept.

    A null or blank text has no words and fails. Rows are judged one by one, so
    repeated rows and ties get equal verdicts; other columns are not looked at, and
    an empty table gives an empty result.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("_text"))
    return _verdict(rows, [F.col("doc_id")], rules)


RESULT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns as they were."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col("text").cast("string").alias("_text"))
    return _verdict(rows, [F.col("_row")], rules).filter("kept").select("_row.*")


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
p AS (SELECT doc_id, unnest(range(len(words) - 4)) AS i, words FROM w),
h AS (SELECT doc_id, i, array_to_string(words[i + 1 : i + 5], ' ') AS g FROM p),
t AS (SELECT doc_id, g FROM h GROUP BY doc_id, g HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT x) AS n FROM (
    SELECT h.doc_id, unnest(range(h.i, h.i + 5)) AS x FROM h JOIN t USING (doc_id, g)) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: list_contains(STOPS, lower(x)))) AS n_stops
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(word_chars / n_words < 1.5, false)
    AND NOT coalesce(word_chars / n_words > 20.0, false) AND NOT coalesce(n_symbols / n_words > 0.25, false)
    AND NOT coalesce(n_words >= 50 AND n_stops / n_words < 0.01, false)
    AND NOT coalesce(n_dup_lines / n_lines > 0.5, false) AS kept
FROM f
""".replace("STOPS", "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]")
