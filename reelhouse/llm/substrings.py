"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if it lies in a string of `length` bytes that also starts earlier: in a row with a
smaller id, or earlier in the same row. Strings are judged on the input.

Method. Every window of `length` bytes is represented by the least hashed `GRAM`-gram inside it
(the leftmost of equals), which depends on the window's bytes alone, so equal windows share it.
Neighbouring windows with one such anchor form a context. Contexts are grouped by their anchor
in buckets of hash values; equal contexts collapse to their first place, inside each task before
the shuffle and inside each bucket after it, and all later places are repeats. Where an anchor
has different contexts, their bytes are fetched and gathered in shards by anchor. A shard's
suffix array (`suffixes.py`: leftmost-smaller substrings sorted and named recursively, the array
induced from them) and its permuted common prefixes give the windows that agree in `length`
bytes; of those, all but the first are repeats.

An anchor with more than `most_contexts` different contexts (one passage behind thousands of
different openings) would make an unbounded shard. Its windows are instead spread by their own
128-bit hashes and collapsed like contexts, which is exact as well and pre-aggregates.

Scale: three shuffles of packed columns and two of compressed texts, all by hash; buckets and
shards are counted by `spark.sql.shuffle.partitions`. Nothing is collected or broadcast.

Cases: a null text has no bytes and stays null in the output text. Texts shorter than `length`
are left alone. A null id sorts last. Identical rows are one document, so neither removes the
other's bytes; rows that share an id, or have none, but not their text are told apart and ordered by a
64-bit hash of the text. An empty table gives an empty result. Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelhouse.llm.blobs import Columns, Layout, changes, joined, take
from reelhouse.llm.rows import bucket_count, chosen, over_batches
from reelhouse.llm.suffixes import permuted_common_prefixes, suffix_array
from reelhouse.session import scratch_dir

LENGTH = 100
GRAM = 32
MOST_CONTEXTS = 2048
#: Bytes that are hashed at a time, and windows of a long text that are taken at a time.
GROUP = SEGMENT = 1 << 17
#: Parts of a shard by anchor, so that each suffix array is short enough for the processor's cache.
PARTS = 16

PLACES = Layout(
    key_hi="u2", key_lo="u4", same="u8", doc="i8", text="i8", start="u4", more="u1", left="u1"
)
SPANS = Layout(doc="i8", text="i8", start="u4", size="u4")
WANTED = Layout(
    key_hi="u2", key_lo="u4", doc="i8", text="i8", start="u4", more="u1", left="u1", hot="u1"
)
CONTEXTS = Layout(doc="i8", text="i8", start="u4", more="u1", part="u1")
WINDOWS = Layout(key="u8", same="u8", doc="i8", text="i8", start="u4")

_ODD = [
    np.uint64(c)
    for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
]
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_LAST = np.iinfo(np.int64).max


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    h = (h ^ (h >> np.uint64(33))) * _ODD[1]
    return h ^ (h >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Sums:
    """Hashes of any stretch of a buffer from sums of powers, after a mixing step."""

    def __init__(self, size: int, base: int):
        self.up = _powers(base, size + 1)
        self.down = _powers(pow(base, -1, 1 << 64), size + 1)

    def over(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts])


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the `GRAM` bytes that start at each place."""
    n = len(data) - GRAM + 1
    words = np.ndarray((len(data) - 7,), np.uint64, data.tobytes(), 0, (1,))
    out = np.zeros(n, np.uint64)
    for j in range(0, GRAM, 8):
        out += words[j : j + n] * _ODD[j // 8]
        out ^= out >> np.uint64(31)
    return mixed(out)


def window_anchors(hashes: np.ndarray, length: int) -> np.ndarray:
    """For each window, the place of its least hash, the leftmost of equals."""
    bits = np.uint64(20)
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width, span = length - GRAM + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    return (least & np.uint64((1 << 20) - 1)).astype(np.int64)


def contexts(texts: list[bytes], length: int, sums: Sums) -> Columns:
    """Every context of some texts: `row` (place in the list) and the columns of `PLACES`
    without doc and text."""
    pieces = [
        (row, a, t[a : a + SEGMENT + length - 1])
        for row, t in enumerate(texts)
        for a in range(0, len(t) - length + 1, SEGMENT)
    ]
    found, group, size = [], [], 0
    for i, piece in enumerate(pieces):
        group.append(piece)
        size += len(piece[2])
        if size >= GROUP or i == len(pieces) - 1:
            found.append(_contexts_of(group, length, sums))
            group, size = [], 0
    names = ("row", "key", "same", "start", "more", "left")
    if not found:
        return {n: np.zeros(0, np.uint64 if n in ("key", "same") else np.int64) for n in names}
    return dict(zip(names, map(np.concatenate, zip(*found, strict=True)), strict=True))


def _contexts_of(pieces: list, length: int, sums: Sums) -> tuple:
    sizes = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    hashes = gram_hashes(data)
    anchors = window_anchors(hashes, length)
    piece = np.repeat(np.arange(len(pieces)), sizes - length + 1)
    first = np.concatenate([[0], np.cumsum(sizes - length + 1)])[:-1]
    window = np.arange(len(piece)) - first[piece] + (ends - sizes)[piece]
    anchor = anchors[window]
    new = np.flatnonzero(changes(piece, anchor))
    low, high = window[new], window[np.append(new[1:], len(window)) - 1]
    anchor, piece = anchor[new], piece[new]
    more, left = high - low, anchor - low
    same = sums.over(data, low, high + length) + mixed((more * 256 + left).astype(np.uint64))
    row = np.array([p[0] for p in pieces])[piece]
    start = low - (ends - sizes)[piece] + np.array([p[1] for p in pieces])[piece]
    return row, hashes[anchor], same, start, more, left


def collapse(key: np.ndarray, same: np.ndarray, doc, text, start) -> tuple:
    """Sort places so that equal contexts stand together, the earliest first.

    Returns the order, where a new context begins, and which places repeat an earlier one; places
    that equal the first (of identical rows) are neither first nor repeats.
    """
    order = np.lexsort((start, text, doc, same, key))
    new = changes(key[order], same[order])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    at = order[first]
    repeats = (doc[order] != doc[at]) | (text[order] != text[at]) | (start[order] != start[at])
    return order, new, repeats


def home(doc: np.ndarray, text: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a document."""
    h = mixed(doc.astype(np.uint64) * _ODD[0] + text.astype(np.uint64))
    return (h % np.uint64(buckets)).astype(np.int64)


def merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple:
    """Spans of each owner joined where they overlap or touch."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order].astype(np.int64), end[order].astype(np.int64)
    _, rank = np.unique(owner, return_inverse=True)
    reach = np.maximum.accumulate(rank * (1 << 33) + end) - rank * (1 << 33)
    new = changes(owner)
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return owner[at], start[at], reach[np.append(at[1:], len(start)) - 1] if len(at) else reach


def _identity(ids: pa.Array, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    doc = ids.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)
    return doc, np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)


def _place_rows(length: int, buckets: int):
    """Per batch of documents: packed contexts by bucket, and spans of repeats inside the batch."""

    def make():
        sums = Sums(GROUP + SEGMENT + length, 0x9E3779B97F4A7C15 | 1)

        def run(ids, texts):
            texts = [t or b"" for t in texts.to_pylist()]
            doc, text = _identity(ids, texts)
            c = contexts(texts, length, sums)
            c["doc"], c["text"] = doc[c["row"]], text[c["row"]]
            order, new, repeats = collapse(c["key"], c["same"], c["doc"], c["text"], c["start"])
            again, firsts = take(c, order[repeats]), take(c, order[new])
            owner, start, end = merged(again["row"], again["start"], again["start"] + again["more"] + length)
            spans = {"doc": doc[owner], "text": text[owner], "start": start, "size": end - start}
            key = firsts["key"] >> np.uint64(16)
            firsts["key_hi"], firsts["key_lo"] = key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)
            places = PLACES.by_group(firsts, (key % np.uint64(buckets)).astype(np.int64))
            known = SPANS.by_group(spans, home(spans["doc"], spans["text"], buckets))
            n, m = len(places[0]), len(known[0])
            return places[0] + known[0], [0] * n + [1] * m, places[1] + known[1]

        return run

    return make


def _key(c: Columns) -> np.ndarray:
    return (c["key_hi"].astype(np.uint64) << np.uint64(32)) | c["key_lo"]


def _of_kind(table: pa.Table, kind: int) -> list[bytes]:
    return [b for k, b in zip(table["kind"].to_pylist(), table["blob"].to_pylist(), strict=True) if k == kind]


def _table(schema: pa.Schema, *columns) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _settle_bucket(length: int, buckets: int, most_contexts: int):
    """Per bucket: spans of repeated contexts, and the contexts whose bytes must be compared."""

    def run(table: pa.Table) -> pa.Table:
        c = PLACES.unpack(_of_kind(table, 0))
        spans = SPANS.unpack(_of_kind(table, 1))
        key = _key(c)
        order, new, repeats = collapse(key, c["same"], c["doc"], c["text"], c["start"])
        again = take(c, order[repeats])
        size = again["more"].astype(np.int64) + length
        spans = joined(spans, {**{n: again[n] for n in ("doc", "text", "start")}, "size": size})
        firsts, keys = take(c, order[new]), key[order[new]]
        group = np.cumsum(changes(keys)) - 1
        sizes = np.bincount(group)
        wanted = take(firsts, sizes[group] > 1)
        wanted["hot"] = sizes[group][sizes[group] > 1] > most_contexts
        a = SPANS.by_group(spans, home(spans["doc"], spans["text"], buckets))
        b = WANTED.by_group(wanted, home(wanted["doc"], wanted["text"], buckets))
        kinds = [1] * len(a[0]) + [2] * len(b[0])
        return _table(_BLOBS, a[0] + b[0], kinds, a[1] + b[1])

    return run


_BLOBS = pa.schema([("bucket", pa.int64()), ("kind", pa.int8()), ("blob", pa.binary())])
_BLOB_DDL = "bucket long, kind byte, blob binary"


def _fetch(length: int, buckets: int):
    """Per bucket of documents: the bytes of wanted contexts by shard; windows of hot ones."""

    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        w = WANTED.unpack(wanted["blob"].to_pylist())
        unpacked = _texts(docs)
        picked = [
            unpacked[d, t][s : s + m + length]
            for d, t, s, m in zip(*(w[n].tolist() for n in ("doc", "text", "start", "more")), strict=True)
        ]
        hot = w["hot"].astype(bool)
        ids, kinds, blobs = [], [], []
        shard = (_key(w) % np.uint64(buckets)).astype(np.int64)
        w["part"] = _key(w) // np.uint64(buckets) % np.uint64(PARTS)
        order = np.argsort(np.where(hot, buckets, shard), kind="stable")
        order = order[~hot[order]]
        for part in np.split(order, np.flatnonzero(changes(shard[order]))[1:]) if len(order) else ():
            ids.append(int(shard[part[0]]))
            kinds.append(3)
            columns = CONTEXTS.pack(take(w, part))
            blobs.append(len(part).to_bytes(8, "little") + columns + b"".join(picked[i] for i in part))
        if hot.any():
            windows, spans = _hot_windows(take(w, hot), [p for p, h in zip(picked, hot, strict=True) if h], length)
            a = WINDOWS.by_group(windows, (windows["key"] % np.uint64(buckets)).astype(np.int64))
            b = SPANS.by_group(spans, home(spans["doc"], spans["text"], buckets))
            ids += a[0] + b[0]
            kinds += [4] * len(a[0]) + [1] * len(b[0])
            blobs += a[1] + b[1]
        return _table(_BLOBS, ids, kinds, blobs)

    return run


def _hot_windows(w: Columns, picked: list[bytes], length: int) -> tuple[Columns, Columns]:
    """Windows of contexts by their own hashes, collapsed here; later places are spans already."""
    data = np.frombuffer(b"".join(picked), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(p) for p in picked])])[:-1]
    counts = w["more"].astype(np.int64) + 1
    owner = np.repeat(np.arange(len(picked)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begin[owner] + offset
    c = {n: w[n][owner] for n in ("doc", "text")}
    c["start"] = w["start"][owner].astype(np.int64) + offset
    for name, base in (("key", 0x9E3779B97F4A7C15), ("same", 0xD6E8FEB86659FD93)):
        c[name] = Sums(len(data), base | 1).over(data, at, at + length)
    return _first_windows(c, length)


def _first_windows(c: Columns, length: int) -> tuple[Columns, Columns]:
    order, new, repeats = collapse(c["key"], c["same"], c["doc"], c["text"], c["start"])
    again = take(c, order[repeats])
    spans = {n: again[n] for n in ("doc", "text", "start")}
    spans["size"] = np.full(len(again["doc"]), length)
    return take(c, order[new]), spans


def repeated_windows(c: Columns, data: np.ndarray, length: int) -> Columns:
    """Spans of the windows of a shard's contexts that start earlier in the shard as well.

    `data` holds the contexts' bytes one after the other.
    """
    counts = c["more"].astype(np.int64) + 1
    sizes = counts + length - 1
    n = int(sizes.sum()) + len(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    text = np.ones(n + 1, np.int64)  # 1 ends a context, 0 ends the text
    text[np.arange(len(data)) + owner] = data.astype(np.int64) + 2
    text[n] = 0
    sa = suffix_array(text)
    common = permuted_common_prefixes(text.astype(np.uint8), sa, length)
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    context = np.full(n + 1, -1)
    context[begin[owner] + offset] = owner
    run = np.cumsum(common[sa] < length)
    ranked = context[sa] >= 0
    place, run = sa[ranked], run[ranked]
    owner = context[place]
    doc, row = c["doc"][owner], c["text"][owner]
    start = c["start"][owner].astype(np.int64) + place - begin[owner]
    order, _, repeats = collapse(run, run, doc, row, start)
    at = order[repeats]
    owner, start, end = merged(owner[at], start[at], start[at] + length)
    return {"doc": c["doc"][owner], "text": c["text"][owner], "start": start, "size": end - start}


def _settle_shard(length: int, buckets: int):
    """Per shard: spans from its suffix array, and from hot windows."""

    def run(table: pa.Table) -> pa.Table:
        spans = [SPANS.unpack(_of_kind(table, 1))]
        columns, data = [], []
        for blob in _of_kind(table, 3):
            end = 8 + int.from_bytes(blob[:8], "little") * CONTEXTS.width
            columns.append(blob[8:end])
            data.append(blob[end:])
        if columns:
            c, data = CONTEXTS.unpack(columns), np.frombuffer(b"".join(data), np.uint8)
            owner = np.repeat(np.arange(len(c["more"])), c["more"].astype(np.int64) + length)
            for part in np.unique(c["part"]):
                inside = c["part"] == part
                spans.append(repeated_windows(take(c, inside), data[inside[owner]], length))
        spans.append(_first_windows(WINDOWS.unpack(_of_kind(table, 4)), length)[1])
        s = joined(*spans)
        groups, blobs = SPANS.by_group(s, home(s["doc"], s["text"], buckets))
        return _table(_BLOBS, groups, [1] * len(groups), blobs)

    return run


def _packed(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows with their bucket, identity and compressed text; null texts stay null."""
    fields = [f for f in docs.schema.fields if f.name != "_text"]
    struct = T.StructType.fromDDL("bucket long, _doc long, _hash long, _packed binary")
    struct = T.StructType([*struct.fields, *fields])

    def run(batches):
        target = to_arrow_schema(struct)
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            doc, text = _identity(batch.column("_id"), [t or b"" for t in texts])
            made = [
                pa.array(home(doc, text, buckets)),
                pa.array(doc),
                pa.array(text),
                pa.array([None if t is None else squeeze.compress(t) for t in texts], pa.binary()),
            ]
            rest = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip([*made, *rest], target, strict=True)], schema=target
            )

    return docs.mapInArrow(run, struct)


def _texts(docs: pa.Table) -> dict[tuple[int, int], bytes]:
    expand = zstandard.ZstdDecompressor()
    names = ("_doc", "_hash", "_packed")
    return {
        (d, h): b"" if p is None else expand.decompress(p)
        for d, h, p in zip(*(docs[n].to_pylist() for n in names), strict=True)
    }


def _spans_of(table: pa.Table) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Maximal removed runs of each document."""
    s = SPANS.unpack(table["blob"].to_pylist())
    pairs = np.empty(len(s["doc"]), [("doc", "i8"), ("text", "i8")])
    pairs["doc"], pairs["text"] = s["doc"], s["text"]
    names, owner = np.unique(pairs, return_inverse=True)
    owner, start, end = merged(owner, s["start"], s["start"].astype(np.int64) + s["size"])
    out: dict = {}
    for o, a, b in zip(owner.tolist(), start.tolist(), end.tolist(), strict=True):
        out.setdefault((int(names["doc"][o]), int(names["text"][o])), []).append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> str:
    """What is left of a UTF-8 text when only characters go that lie in a span completely."""

    def starts_one(i: int) -> bool:
        return i >= len(text) or text[i] & 0xC0 != 0x80

    inner = []
    for a, b in spans:
        while a < b and not starts_one(a):
            a += 1
        while b > a and not starts_one(b):
            b -= 1
        inner.append((a, b))
    return without(text, inner).decode()


def _finish(fields: list[T.StructField], with_text: bool, schema: T.StructType):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        target = to_arrow_schema(schema)
        spans, expand = _spans_of(found), zstandard.ZstdDecompressor()
        made = []
        names = ("_doc", "_hash", "_packed")
        for d, h, p in zip(*(docs[n].to_pylist() for n in names), strict=True):
            text = b"" if p is None else expand.decompress(p)
            gone = spans.get((d, h), [])
            digest = (
                len(text),
                sum(b - a for a, b in gone),
                len(gone),
                hashlib.sha256(without(text, gone)).hexdigest(),
            )
            left = None if p is None else whole_characters(text, gone)
            made.append((*digest, left) if with_text else digest)
        columns = list(zip(*made, strict=True)) if made else [[] for _ in range(4 + with_text)]
        arrays = [docs[f.name] for f in fields] + [
            pa.array(c, f.type) for c, f in zip(columns, list(target)[len(fields) :], strict=True)
        ]
        return pa.table(arrays, schema=target)

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = True,
    carry: bool = True,
    most_contexts: int = MOST_CONTEXTS,
) -> DataFrame:
    """The rows with n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256, then the
    text without the removed bytes if `with_text`.

    The digest is of the bytes that are left; the text keeps characters of which some byte is
    left. With `carry`, all other columns are kept; measures that clash with one replace it.
    """
    if length < GRAM:
        raise ValueError(f"strings must have at least {GRAM} bytes, not {length}")
    spark = docs.sparkSession
    buckets = bucket_count(docs)
    others = [c for c in docs.columns if carry and c not in (id_col, text_col)]
    source = chosen(docs, _id=id_col, _text=text_col, **{f"_c{i}": c for i, c in enumerate(others)})
    source = source.withColumn("_id", F.col("_id").cast("long")).withColumn(
        "_text", F.col("_text").cast("binary")
    )
    places = over_batches(source.select("_id", "_text"), _place_rows(length, buckets), _BLOB_DDL)
    settled = places.groupBy("bucket").applyInArrow(
        _settle_bucket(length, buckets, most_contexts), _BLOB_DDL
    )
    folder = f"{scratch_dir(spark)}/settled"
    settled.write.parquet(folder)
    settled = spark.read.schema(_BLOB_DDL).parquet(folder)

    def by_bucket(df):
        return df.groupBy("bucket")

    wanted = settled.filter("kind = 2").select("bucket", "blob")
    light = _packed(source.select("_id", "_text"), buckets).drop("_id")
    fetched = by_bucket(light).cogroup(by_bucket(wanted)).applyInArrow(
        _fetch(length, buckets), _BLOB_DDL
    )
    spans = by_bucket(fetched).applyInArrow(_settle_shard(length, buckets), _BLOB_DDL)
    spans = spans.union(settled.filter("kind = 1")).select("bucket", "blob")
    full = _packed(source, buckets)
    fields = [f for f in full.schema.fields if f.name not in ("bucket", "_doc", "_hash", "_packed")]
    measures = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        measures += ", _text string"
    schema = T.StructType([*fields, *T.StructType.fromDDL(measures).fields])
    done = by_bucket(full).cogroup(by_bucket(spans)).applyInArrow(
        _finish(fields, with_text, schema), schema
    )
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    names = {"_id": id_col, "_text": text_col} | {f"_c{i}": c for i, c in enumerate(others)}
    kept = [done[c].alias(n) for c, n in names.items() if c in done.columns and n not in made]
    return done.select(*kept, *made)
