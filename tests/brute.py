"""Plain-Python versions of the order-dependent operators, one recording at a time."""

from __future__ import annotations

import math
from itertools import groupby

SLEEP = {"N1", "N2", "N3", "REM"}


def stage(text: str) -> str:
    text = text.lower()
    for part, label in (
        ("stage w", "W"),
        ("stage r", "REM"),
        ("stage 1", "N1"),
        ("stage 2", "N2"),
        ("stage 3", "N3"),
        ("stage 4", "N3"),
    ):
        if "sleep " + part in text:
            return label
    return "UNKNOWN"


def timed(annotations):
    """(seq, onset, duration, text) sorted, durations filled, onsets from 0."""
    kept = [
        a
        for a in annotations
        if "sleep stage" in a[3].lower() or "movement time" in a[3].lower()
    ]
    kept.sort(key=lambda a: (a[1], a[0]))
    filled = []
    for i, (seq, onset, duration, text) in enumerate(kept):
        if duration <= 0:
            duration = kept[i + 1][1] - onset if i + 1 < len(kept) else 30.0
        filled.append((seq, onset, duration, text))
    start = filled[0][1] if filled else 0.0
    return [(seq, onset - start, duration, text) for seq, onset, duration, text in filled]


def epochs(annotations):
    rows = timed(annotations)
    if not rows:
        return []
    span = math.ceil(max(onset + duration for _, onset, duration, _ in rows))
    labels = ["UNKNOWN"] * math.ceil(span / 30)
    for _, onset, duration, text in rows:
        first = max(0, math.floor(onset / 30))
        end = min(len(labels), math.ceil((onset + duration) / 30))
        labels[first:end] = [stage(text)] * max(0, end - first)
    return labels


def window(labelled):
    """(index, label) rows from the first to the last sleep row."""
    asleep = [i for i, (_, label) in enumerate(labelled) if label in SLEEP]
    return labelled[asleep[0] : asleep[-1] + 1] if asleep else []


def activity(labelled):
    rows = [label for _, label in window(labelled)]
    pairs = list(zip([None] + rows, rows))
    transitions = sum(
        1 for before, now in pairs if before is not None and now is not None and now != before
    )
    awakenings = sum(1 for before, now in pairs if now == "W" and before != "W")
    return transitions, awakenings


def bouts(labelled):
    runs = [(label, len(list(rows))) for label, rows in groupby(l for _, l in window(labelled))]

    def longest(labels):
        return max([n for label, n in runs if label in labels], default=0) / 2

    return longest({"N3"}), longest({"REM"}), longest(SLEEP)
