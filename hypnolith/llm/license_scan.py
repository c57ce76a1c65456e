"""License scans: exact set-similarity join of text blocks with license templates.

A block is a run of consecutive words of a text, line feeds or not, of at most the
template's words divided by ``THRESHOLD``: a template may be wrapped, and up to a fifth
of its block may be other words, but scattered words are none. It is found in a block
that holds at least ``THRESHOLD`` of its distinct tokens. The join is the usual one
for such thresholds:

* tokens have one global order, by the number of documents that hold them, rarest
  first. Only tokens of templates can overlap, so others need no place in it;
* prefix filter: a block that meets the threshold holds one of the template's
  size - overlap + 1 rarest tokens. Texts without any of them are passed over;
* texts are cut into stretches of ``STRETCH`` words and what a block begun in them may
  need after; stretches, not blocks, are joined on prefix tokens;
* length filter: a stretch must hold as many template tokens as the overlap needs;
* positional filter: the common token that is rarest is in the prefix, so from that
  token on enough tokens must be left on both sides, and be common;
* what remains is verified on all blocks of the stretch that begin with a token of the
  template; others hold no more than one of these.

Templates are a fixed table of a few hundred tokens, so that side is broadcast; the
text side is never shuffled, only the matches found.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hypnolith.llm.tables import computed

THRESHOLD = 0.8
#: Words of a text in which blocks begin that are joined together.
STRETCH = 256
#: Runs of other ASCII characters separate tokens; letters are lower-cased before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose places are counted.
PHRASES = {
    "cc-by": ("cc", "by"),
    "gpl": ("general", "public", "license"),
    "reserved": ("all", "rights", "reserved"),
}

#: Sentences by which licenses are stated.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "This work is dedicated to the public domain under CC0 1.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
)


def tokens_of(text: Column) -> Column:
    """Array of the tokens of a text, A-Z lower-cased; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, SEPARATORS), lambda token: token != F.lit(""))


def _template_tokens(text: str) -> list[str]:
    return [t for t in re.split(SEPARATORS, text.lower()) if t]


def _bounds(tokens: list[str], threshold: float) -> tuple[int, int]:
    """Distinct tokens that must be common, and the most words of a block."""
    need = math.ceil(threshold * len(set(tokens)) - 1e-9)
    return max(1, need), max(1, math.floor(len(tokens) / threshold + 1e-9))


@dataclass(frozen=True)
class Templates:
    """Templates with their tokens in the global order."""

    order: list[str]
    rows: list[tuple[int, str, list[str], int, int]]  # id, label, tokens in order, overlap needed, words of a block

    @property
    def prefix(self) -> list[str]:
        found = {t for _, _, tokens, need, _ in self.rows for t in tokens[: len(tokens) - need + 1]}
        return sorted(found)

    @property
    def widest(self) -> int:
        return max((width for *_, width in self.rows), default=1)

    def frame(self, spark) -> DataFrame:
        """One row per template and prefix token, with the tokens from that one on."""
        rows = [
            (label, len(tokens), tokens[place:], need, width, token)
            for _, label, tokens, need, width in self.rows
            for place, token in enumerate(tokens[: len(tokens) - need + 1])
        ]
        return spark.createDataFrame(
            rows, "label string, t_size int, t_rest array<string>, need int, width int, token string"
        )


def ordered_templates(tokens: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> Templates:
    """Order template tokens by how many rows of ``tokens`` (arrays ``tokens``) hold them.

    All rows are counted; what comes to the driver is one number per template token.
    """
    sets = [(label, _template_tokens(text)) for label, text in templates]
    known = sorted({t for _, s in sets for t in s})
    held = F.array_intersect(F.lit(known), F.col("tokens"))
    counts = tokens.select(F.explode(held).alias("token")).groupBy("token").count()
    seen = {row["token"]: row["count"] for row in counts.collect()}
    order = sorted(known, key=lambda t: (seen.get(t, 0), t))
    place = {t: k for k, t in enumerate(order)}
    rows = [
        (number, label, sorted(set(s), key=place.__getitem__), *_bounds(s, threshold))
        for number, (label, s) in enumerate(sets)
    ]
    return Templates(order, rows)


def block_matches(docs: DataFrame, templates: Templates) -> DataFrame:
    """doc_id, label and containment of every (stretch, template) with a block that meets the threshold.

    ``docs`` has doc_id and the array ``tokens`` of the whole text. Containment is that
    of the stretch's best block.
    """
    spark = docs.sparkSession
    prefix = F.lit(templates.prefix)
    cut = F.transform(
        F.sequence(F.lit(0), F.size("tokens") - 1, F.lit(STRETCH)),
        lambda at: F.slice("tokens", at + 1, F.lit(STRETCH + templates.widest - 1)),
    )
    stretches = (
        docs.filter(F.arrays_overlap("tokens", prefix))
        .select("doc_id", F.explode(cut).alias("words"))
        .filter(F.arrays_overlap("words", prefix))
    )
    held = computed(
        stretches,
        [F.col("doc_id"), F.col("words")],
        b_tokens=F.array_intersect(F.lit(templates.order), F.col("words")),
    )
    numbered = F.transform("b_tokens", lambda token, k: F.struct(k.alias("b_place"), token.alias("token")))
    keys = F.filter(numbered, lambda pair: F.array_contains(prefix, pair["token"]))
    pairs = held.select("doc_id", "words", "b_tokens", F.inline(keys)).join(
        F.broadcast(templates.frame(spark)), "token"
    )
    left = F.least(F.size("t_rest"), F.size("b_tokens") - F.col("b_place"))
    candidates = pairs.filter(left >= F.col("need")).filter(
        F.size(F.array_intersect("t_rest", "b_tokens")) >= F.col("need")
    )
    begins = F.filter(
        F.transform("words", lambda word, k: F.when(F.array_contains("t_rest", word), k)), lambda k: k.isNotNull()
    )
    best = F.array_max(
        F.transform(
            begins, lambda k: F.size(F.array_intersect(F.slice("words", k + 1, F.col("width")), F.col("t_rest")))
        )
    )
    return (
        computed(candidates, [F.col("doc_id"), F.col("label"), F.col("t_size"), F.col("need")], common=best)
        .filter("common >= need")
        .select("doc_id", "label", (F.col("common") / F.col("t_size")).alias("containment"))
    )


def _places(tokens: Column, phrase: tuple[str, ...]) -> Column:
    """Starts of a phrase's words standing consecutively."""

    def start(token: Column, at: Column) -> Column:
        here = token == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            here = here & (F.get(tokens, at + k) == word)
        return F.when(here, at)

    found = F.filter(F.transform(tokens, start), lambda at: at.isNotNull())
    all_held = F.lit(True)
    for word in phrase:
        all_held = all_held & F.array_contains(tokens, word)
    return F.when(all_held, found).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Base places are counted over the whole text, across lines. ``labels`` adds those
    of templates found in a block; ``score`` is the best containment found, 0 if none.
    Null and empty texts have no words and no labels. Rows with one doc_id (or with
    none) share the template labels found in any of them. Other columns are ignored;
    an empty table gives an empty result.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = computed(texts, [F.col("doc_id"), F.col("text")], tokens=tokens_of(F.col("text")))
    known = ordered_templates(rows, templates, threshold)
    matches = (
        block_matches(rows, known)
        .groupBy("doc_id")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
        .withColumnRenamed("doc_id", "found_id")
    )
    places = rows.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_words"),
        *[_places(F.col("tokens"), phrase).alias(f"_{k}") for k, phrase in enumerate(PHRASES.values())],
    )
    columns = [F.col(f"_{k}") for k in range(len(PHRASES))]
    base = F.array_compact(
        F.array(*[F.when(F.size(c) > 0, F.lit(label)) for c, label in zip(columns, PHRASES, strict=True)])
    )
    every = F.concat(*columns)
    based = places.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(base).alias("_base"),
    )
    none = F.array().cast("array<string>")
    return based.join(matches, F.col("doc_id").eqNullSafe(F.col("found_id")), "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("best", F.lit(0.0)).alias("score"),
    )


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _oracle() -> str:
    sets = [(k, label, _template_tokens(text)) for k, (label, text) in enumerate(TEMPLATES)]
    rows = ", ".join(
        f"({k}, '{label}', {_sql_list(sorted(set(s)))}, {', '.join(map(str, _bounds(s, THRESHOLD)))})"
        for k, label, s in sets
    )
    found = " UNION ALL ".join(
        f"SELECT doc_id, i, '{label}' AS label FROM p WHERE tokens[i + 1 : i + {len(phrase)}] = {_sql_list(phrase)}"
        for label, phrase in PHRASES.items()
    )
    split = (
        r"list_filter(string_split_regex(translate(coalesce({}, ''), '" + UPPER + "', '" + LOWER
        + r"'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    )
    return f"""
WITH t(template, label, tokens, need, width) AS (VALUES {rows}),
d AS (SELECT doc_id, text, {split.format('text')} AS tokens FROM documents),
p AS (SELECT doc_id, tokens, unnest(range(len(tokens))) AS i FROM d),
b AS ({found}),
a AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
    list(DISTINCT label) AS base FROM b GROUP BY doc_id),
u AS (SELECT template, width, unnest(tokens) AS token FROM t),
w AS (SELECT doc_id, unnest(tokens) AS token, unnest(range(len(tokens))) AS i FROM d),
c AS (SELECT w.doc_id, template, count(DISTINCT token) OVER (PARTITION BY w.doc_id, template ORDER BY i
    RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING) AS common FROM w JOIN u USING (token)),
m AS (SELECT doc_id, list(DISTINCT label) AS found, max(common / len(tokens)) AS best
  FROM c JOIN t USING (template) WHERE common >= need GROUP BY doc_id)
SELECT d.doc_id, len(d.tokens)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(found, [])))), ',') AS labels,
  coalesce(best, 0)::DOUBLE AS score
FROM d LEFT JOIN a ON d.doc_id = a.doc_id LEFT JOIN m ON d.doc_id = m.doc_id
"""


ORACLE = _oracle()
