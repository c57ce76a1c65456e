"""Plain Python versions of the training-data operators, one pair or one text at a time."""

from __future__ import annotations

import hashlib


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def remove_repeats(docs: list[tuple[int, str | None]], window: int = 50) -> dict:
    first: dict[tuple, int] = {}
    for doc_id, text in docs:
        w = words(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = {}
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < doc_id:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[doc_id] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def lower(text: str | None) -> str:
    return (text or "").encode().lower().decode()


def shingles(text: str | None, size: int = 5) -> frozenset:
    w = words(lower(text))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1))


def jaccard_components(docs: list[tuple[int, str | None]], percent: int = 80) -> dict:
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    p, q = sorted((root(a), root(b)))
                    parent[q] = p
    return {d: (len(x), root(d)) for d, x in sets}


def base_scores(docs: list[tuple[int, str | None]]) -> dict:
    import math
    import zlib
    from collections import Counter

    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    tokens = {d: [*words(lower(t)), None] for d, t in docs}
    counts = Counter(x for d, _ in docs if not held[d] for x in tokens[d])
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for d, _ in docs:
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in tokens[d])
        out[d] = (held[d], len(tokens[d]), sum(counts[x] > 0 for x in tokens[d]), total, base)
    return out


def edit_distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def within_one_edit(a: tuple, b: tuple) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    x, y = a[head:], b[head:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:]


def repeated_lines(docs: list[tuple[int, str | None]], least: int = 8) -> dict:
    lines = sorted(
        (d, k, tuple(words(line))) for d, t in docs for k, line in enumerate((t or "").split("\n")) if words(line)
    )
    first: dict[tuple, tuple] = {}
    for d, k, w in lines:
        first.setdefault(w, (d, k))
    near = set()
    long_ = sorted((w for w in first if len(w) >= least), key=first.__getitem__)
    for k, w in enumerate(long_):
        if any(within_one_edit(w, v) for v in long_[:k] if abs(len(w) - len(v)) <= 1):
            near.add(w)
    out = {d: [0, 0, 0, []] for d, _ in docs}
    for d, k, w in lines:
        o = out[d]
        o[0] += 1
        if first[w] < (d, k):
            o[1] += 1
        elif w in near:
            o[2] += 1
        if first[w] < (d, k) or w in near:
            o[3].append(k)
    return out


def class_scores(docs: list[tuple[int, list[int]]], held: set, end: int, classes: int, rounds: int, prior: float, most: int) -> dict:
    """log10 probabilities of texts, given as word numbers, under the class model, word by word."""
    import math
    from collections import Counter, defaultdict

    import numpy as np

    train = [tokens for d, tokens in docs if d not in held]
    total_of = Counter(w for tokens in train for w in tokens)
    signed = lambda w: w - (1 << 64) if w >> 63 else w
    top = sorted((w for w, n in total_of.items() if n > 1), key=lambda w: (-total_of[w], signed(w)))[:most]
    moved = {w: k % classes for k, w in enumerate(top)}

    def vectors_now():
        seen: dict = defaultdict(lambda: np.zeros(2 * (classes + 1)))
        for tokens in train:
            for k, word in enumerate(tokens):
                seen[word][moved.get(tokens[k - 1] if k else end, classes)] += 1
                if k + 1 < len(tokens):
                    seen[word][classes + 1 + moved.get(tokens[k + 1], classes)] += 1
        return seen

    for _ in range(rounds):
        seen, sums = vectors_now(), np.zeros((2 * (classes + 1), classes))
        for word, k in moved.items():
            sums[:, k] += seen[word]
        gain = np.log((sums + 0.5) / (sums + 0.5).sum(axis=0))
        moved = {w: int(np.argmax(seen[w][None] @ gain)) for w in moved}
    seen = vectors_now()
    kind = {
        w: classes if n < 2 else moved[w] if w in moved else int(np.argmax(seen[w][None] @ gain))
        for w, n in total_of.items()
    }
    size, rare = Counter(), sum(k == classes for k in kind.values())
    for w, k in kind.items():
        size[k] += total_of[w]
    start = kind.get(end, classes)
    moves = Counter()
    for tokens in train:
        own = [kind[w] for w in tokens]
        moves.update(zip([start, *own], own))
    into, out = Counter(), Counter()
    for (i, j), n in moves.items():
        out[i] += n
        into[j] += n
    total = sum(into.values())
    scores = {}
    for d, tokens in docs:
        own, score = [kind.get(w, classes) for w in tokens], 0.0
        for i, j, w in zip([start, *own], own, tokens):
            overall = (into[j] + 1) / (total + classes + 1)
            score += math.log10((moves[i, j] + prior * overall) / (out[i] + prior))
            score += math.log10(total_of[w] / size[j]) if j < classes else -math.log10(rare + 1)
        scores[d] = score
    return scores
