"""Plain versions of the operators, and rows that are hard in some way."""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections import Counter

SMALL = "/root/testdata/sf0.001"
PROSE = (
    "Anat with by of nteres atre are on the erha of thwh and the oned in a tion that was heonth "
    "edre ly the ou re st be to ing on with erst and nd is of the thsh in a blere that the heed. "
)
LONG = " ".join(f"w{i % 977}x{i * i % 1009}" for i in range(30_000))

#: (doc_id, text, lang, source, n_chars): nulls everywhere, empty and very long texts, repeated
#: rows, ties, special strings, and characters of all sizes.
ODD_DOCUMENTS = [
    (None, PROSE * 2, "en", "a", 1),
    (None, PROSE * 2, None, None, None),
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, " \n\t \n", "en", "a", 5),
    (4, "one two", "en", "a", 7),
    (5, "One TWO", None, "b", 7),
    (6, PROSE * 3, "en", "a", 1),
    (6, PROSE * 3, "en", "a", 1),
    (7, PROSE * 3 + "with another end", "en", "b", 1),
    (8, "x" * 450, "en", "b", 450),
    (9, "é" * 130 + " ü日本語🙂 " * 30, "fr", "c", 1),
    (10, LONG, "en", "c", 1),
    (11, LONG + " tail", "en", "a", 1),
    (12, "before <|endoftext|> after\x85 a\x1cb  c <|endoftext|>", "en", "a", 1),
    (13, "# % | &\nmenu | about | login\nAll rights reserved\n" + PROSE, "en", "a", 1),
    (14, "\n".join(PROSE.split(". ")) + "\n" + PROSE, "en", "a", 1),
    (15, PROSE * 3, "en", "d", 1),
    (-3, PROSE * 3 + "with another end", "en", "d", 1),
    (2**62, "one two", "en", "d", 1),
]
DOCUMENT_DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators might use for themselves.
CLASHING = ("key", "kind", "bucket", "n", "sketch", "blob", "_doc", "shard", "kept", "n_bytes", "start")


def odd(spark, rows=None):
    """The odd documents with clashing extra columns."""
    df = spark.createDataFrame(ODD_DOCUMENTS if rows is None else rows, DOCUMENT_DDL)
    return df.selectExpr("*", *(f"'{i}' AS `{c}`" for i, c in enumerate(CLASHING)))


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size=5):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def groups(rows, percent=80):
    """(id, set size, component, kept) of each row, by comparing all sets."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = [(d, s) for d, s in sets if d is not None and s]
    for (a, x), (b, y) in itertools.combinations(linked, 2):
        both = len(x & y)
        if 100 * both >= percent * (len(x) + len(y) - both):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return [
        (d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets
    ]


def removed_spans(rows, length=100):
    """For each row, which bytes go: every window is looked up in all earlier ones."""
    order = sorted({(math.inf if d is None else d, t or b"") for d, t in rows}, key=lambda r: r[0])
    first, cover = {}, {}
    for d, t in order:
        marks = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first.setdefault(t[i : i + length], (d, i)) != (d, i):
                marks[i : i + length] = b"\1" * length
        cover[d, t] = bytes(marks)
    return [cover[math.inf if d is None else d, t or b""] for d, t in rows]


def repeats_digest(rows, length=100):
    out = []
    for (d, t), marks in zip(rows, removed_spans(rows, length), strict=True):
        t = t or b""
        kept = bytes(b for b, gone in zip(t, marks, strict=True) if not gone)
        runs = sum(1 for gone, _ in itertools.groupby(marks) if gone)
        out.append((d, len(t), sum(marks), runs, hashlib.sha256(kept).hexdigest()))
    return out


def base_scores(rows):
    """(id, held out, tokens, known, N, base score) of each row."""
    tokens = [[*words(t), None] for _, t in rows]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0 for d, _ in rows]
    c = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    return [
        (d, h, len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts))
        for (d, _), h, ts in zip(rows, held, tokens, strict=True)
    ]


def best_fit(pieces, capacity):
    """Bins by looking at all of them: (length, source, cluster) in the given order."""
    bins, chosen = [], []
    for length, source, cluster in pieces:
        fits = [
            (b["room"], i)
            for i, b in enumerate(bins)
            if b["room"] >= length and source not in b["sources"] and cluster not in b["clusters"]
        ]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        bins[at]["room"] -= length
        bins[at]["sources"].add(source)
        bins[at]["clusters"].add(cluster)
        chosen.append(at)
    return chosen


def ordered(rows):
    """Rows in an order that nulls do not disturb."""
    return sorted(rows, key=repr)
