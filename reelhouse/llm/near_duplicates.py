"""Near-duplicate documents by HyperMinHash, with links confirmed on full shingle sets.

Method. A document's set holds its distinct five-word shingles (64-bit hashes). A sketch splits
the set into `REGISTERS` buckets and keeps of each bucket's least value the number of leading
zeros and `MANTISSA` bits after the leading one. Bands of compressed registers give candidates.
For a candidate pair the Jaccard similarity is estimated from equal registers, corrected for
those that agree by chance in unrelated sets of these sizes; pairs that stay below the threshold by more than `SIGMAS`
standard deviations are dropped, and all others are confirmed on their full sets.

Equal sets are one node from the start. In each band bucket every node is compared with the
bucket's least node, which is linear in the bucket. What is confirmed joins components. Two more
steps find the links between components that no least node stands on:

1. In buckets that still hold several components, sketches are compared across components, in
   blocks of at most `SKETCHES` by `SKETCHES` nodes. A block gives only as many pairs of
   components as connect those whose estimates pass; the components connected so are a family.
2. In each family every node outside its largest component is compared with the nodes of other
   components, first on sketches and then on full sets, in blocks of about `MEMBERS` by `MEMBERS`
   nodes. Once a block has found two components linked it compares them no further, and it
   returns only the links that joined some.

So no link that would join groups is lost to the stars, nothing is collected, no task holds more
than two blocks of a group, and the pairs of a group are neither formed nor returned.

With 32 bands of four registers, a pair at the threshold of 85 % misses all bands with a
probability below 1e-9, and one at 80 % with a probability below 5e-8.

Cases: a null or empty text, or one without words, has an empty set and is linked with nothing.
A text of fewer than five words has one shingle, the whole sequence. Rows with a null id are
linked with nothing; their component is null and they are kept. Rows that share an id are one
document in the components, with one row each. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.blobs import changes
from reelhouse.llm.components import components, stored
from reelhouse.llm.rows import chosen, over_batches
from reelhouse.operators.joins import join_unique
from reelhouse.session import scratch_dir

WORDS = 5
#: The threshold unless a caller states another one.
CORPUS_PERCENT = 80
REGISTERS = 128
MANTISSA = 26
PER_BAND = 4
SIGMAS = 5.0
SKETCHES = 1024
MEMBERS = 256
#: Shingles for which a block of a family is counted as full, whatever its number of nodes.
BLOCK_SHINGLES = 1 << 19
#: Rows with sketches, and shingles, of the meetings that one call is given.
MET_ROWS = 1 << 16
MET_SHINGLES = 1 << 23
EMPTY = 0xFFFFFFFF
#: Texts that are hashed at a time, and bytes of them in a piece.
AT_ONCE = 500
PIECE = 1 << 16
#: Bits of the table that tells which texts are read again.
SLOTS = 1 << 25

_ODD = [
    np.uint64(c)
    for c in (
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0x27D4EB2F165667C5,
        0xD6E8FEB86659FD93,
        0xA0761D6478BD642F,
        0xE7037ED1A0B428DB,
    )
]
SIGNATURE_DDL = "doc_id long, text_hash long, n long, key binary, sketch binary"


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: For `word_hashes`: the values of bytes, ASCII white space, and powers of an odd number modulo 2 ** 64.
_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD[0])
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = int(_ODD[1])
_POWERS, _INVERSES = (
    np.cumprod(np.append(np.uint64(1), np.full(PIECE - 1, np.uint64(n)))) for n in (_BASE, pow(_BASE, -1, 1 << 64))
)
_TURN_BACK = np.uint64(pow(_BASE, -PIECE, 1 << 64))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of a text that ends in white space, and where the words start.

    A word's hash is the sum of its bytes' values times powers of `_BASE`, so running sums over the
    text give all of them at once; they are taken in pieces, which stay in the processor's cache.
    """
    read = np.frombuffer(text, np.uint8)
    white = _WHITE[read]
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edges = np.append(0, edges)
    starts, ends = edges[0::2], edges[1::2]
    before, behind = np.zeros((2, len(starts)), np.uint64)
    sums = np.zeros(PIECE + 1, np.uint64)
    for a in range(0, len(read), PIECE):
        values = _VALUES[read[a : a + PIECE]]
        values *= _POWERS[: len(values)]
        values[:1] += sums[:1]
        np.cumsum(values, out=sums[1 : len(values) + 1])
        for places, found in ((starts, before), (ends, behind)):
            i, j = np.searchsorted(places, [a, a + len(values)])
            found[i:j] = sums[places[i:j] - a]
        # the next piece begins with the first power again
        sums[:1] = sums[len(values) : len(values) + 1] * _TURN_BACK
    pieces = ends // PIECE - starts // PIECE
    longer = np.flatnonzero(pieces)
    behind[longer] *= np.array([pow(_BASE, PIECE * n, 1 << 64) for n in pieces[longer].tolist()], np.uint64)
    hashes = behind - before
    hashes *= _INVERSES[starts % PIECE]
    return _mixed(hashes), starts


def shingle_sets(texts: list[str | None], words: int = WORDS, any_case: bool = False) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z count as a-z, and with `any_case` all
    letters as their lower-case ones."""
    if any_case:
        read = [(t or "").lower().encode() for t in texts]
    else:
        read = [(t or "").encode().lower() for t in texts]
    hashes, starts = word_hashes(b" ".join([*read, b""]) or b" ")
    ends = np.cumsum([len(t) + 1 for t in read], dtype=np.int64)
    sizes = np.diff(np.searchsorted(starts, ends), prepend=0)
    total = len(hashes)
    mixed = np.zeros(0, np.uint64)
    if total >= words:
        mixed = np.zeros(total - words + 1, np.uint64)
        for k in range(words):
            mixed += hashes[k : total - words + 1 + k] * _multiplier(k)
        mixed = _mixed(mixed)
    out, begin = [], 0
    for n in sizes.tolist():
        if n >= words:
            own = np.sort(mixed[begin : begin + n - words + 1])
            out.append(own[changes(own)])
        elif n:
            part = hashes[begin : begin + n]
            value = np.array([n], np.uint64)
            for k in range(n):
                value = value * _ODD[6] + part[k : k + 1] * _multiplier(k)
            out.append(_mixed(value))
        else:
            out.append(np.zeros(0, np.uint64))
        begin += n
    return out


def _multiplier(k: int) -> np.uint64:
    return _ODD[k] if k < 6 else _mixed(np.array([k], np.uint64))[0] | np.uint64(1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of `REGISTERS` compressed registers per sorted set."""
    bits = REGISTERS.bit_length() - 1
    out = np.full((len(sets), REGISTERS), EMPTY, np.uint32)
    if not any(map(len, sets)):
        return out
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64)
    first = changes(row, bucket)
    least = (values[first] << np.uint64(bits)) >> np.uint64(12)  # 52 bits, exact as doubles
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.minimum(52 - exponent, 62).astype(np.int64)
    after = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    out[row[first], bucket[first]] = (zeros << MANTISSA) | np.where(least > 0, after, 0)
    return out


def band_values(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, band value) for all bands that hold a register."""
    bands = REGISTERS // PER_BAND
    grouped = np.ascontiguousarray(sketch).reshape(len(sketch), bands, PER_BAND)
    row, band = np.nonzero((grouped != EMPTY).any(axis=2))
    value = (band.astype(np.uint64) + np.uint64(1)) * _ODD[0]
    for k in range(PER_BAND):
        value = _mixed(value + grouped[row, band, k]) * _ODD[1]
    return row, value.view(np.int64)


def _level(n: np.ndarray) -> np.ndarray:
    """Set sizes by steps of the square root of two."""
    return np.rint(2 * np.log2(np.maximum(n, 1))).astype(np.int64)


def _chances(levels: int = 128) -> np.ndarray:
    """(level, level): how often registers of unrelated sets agree that hold a value each.

    A register holds the least of about n / `REGISTERS` even values, so it has i leading zeros with
    a probability that follows from n; two that have the same agree in `MANTISSA` more bits.
    """
    per_register = 2.0 ** (np.arange(levels) / 2) / REGISTERS
    edges = np.exp(-per_register[:, None] * 2.0 ** -np.arange(65))  # no value below 2 ** -i
    octaves = np.diff(edges, axis=1) / -np.expm1(-per_register)[:, None]
    return octaves @ octaves.T / (1 << MANTISSA)


CHANCES = _chances()


def estimates(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of registers, corrected for registers that agree by chance in sets
    of these sizes, and the registers that the estimates rest on."""
    used = ((a != EMPTY) | (b != EMPTY)).sum(axis=-1)
    equal = ((a == b) & (a != EMPTY)).sum(axis=-1)
    some = np.maximum(used, 1)
    chance = CHANCES[_level(a_size), _level(b_size)]
    return (equal / some - chance) / (1 - chance), used


def may_link(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, percent: int) -> np.ndarray:
    """Whether the estimate leaves room for the threshold."""
    estimate, used = estimates(a, b, a_size, b_size)
    t = percent / 100
    return estimate >= t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(used, 1))


def signatures(
    docs: DataFrame, words: int, id_col: str, text_col: str, carry: Sequence[str] = (), any_case: bool = False
) -> DataFrame:
    """doc_id, a hash of the text, size of the set, its 128-bit name, its sketch, and the columns
    to carry as `_c0`, `_c1` and so on."""

    def make():
        def run(ids, hashes, texts, *carried):
            n, keys, packed = [], [], []
            for i in range(0, len(texts), AT_ONCE):
                sets = shingle_sets(texts[i : i + AT_ONCE].to_pylist(), words, any_case)
                n += [len(s) for s in sets]
                keys += [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                packed += [s.tobytes() for s in sketches(sets)]
            return ids, hashes, n, keys, packed, *carried

        return run

    names = [f"_c{i}" for i in range(len(carry))]
    source = chosen(docs, doc_id=id_col, text=text_col, **dict(zip(names, carry, strict=True))).select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text", *names
    )
    types = [f"{n} {source.schema[n].dataType.simpleString()}" for n in names]
    return over_batches(source, make, ", ".join([SIGNATURE_DDL, *types]))


def _bands(nodes: DataFrame) -> DataFrame:
    """(band, key, n): one row per node and band."""

    def make():
        def run(keys, n, packed):
            sketch = np.frombuffer(b"".join(packed.to_pylist()), np.uint32).reshape(-1, REGISTERS)
            row, band = band_values(sketch)
            row = pa.array(row)
            return pa.array(band), keys.take(row), n.take(row)

        return run

    return over_batches(nodes.select("key", "n", "sketch"), make, "band long, key binary, n long")


def _slot(column: str):
    return F.pmod(F.xxhash64(column), F.lit(SLOTS))


def _flags(members: DataFrame) -> np.ndarray:
    """A table of `SLOTS` bits, in bytes, with those set that the ids `rep` fall on."""
    place = members.select((_slot("rep") + 1).alias("place"))  # Spark counts the bits from 1
    found = place.groupBy(F.bitmap_bucket_number("place").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    bits = np.zeros((SLOTS // 32768, 4096), np.uint8)
    for row in found.collect():
        bits[row["part"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


def _sets(
    members: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str, any_case: bool
) -> DataFrame:
    """(key, n, sketch, shingles) of nodes, from the text of the document that stands for each.

    A text is read again if its id falls on a bit of such a document. So the sets of these, and of
    few others, are shuffled and no texts; the join by the set's name decides.
    """
    flags = _flags(members)
    texts = chosen(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = texts.filter("doc_id IS NOT NULL").select(_slot("doc_id").alias("slot"), "text")

    def make():
        def run(slots, texts):
            slots = slots.to_numpy()
            texts = texts.filter(pa.array(flags[slots >> 3] >> (slots & 7).astype(np.uint8) & 1 > 0))
            sets = []
            for i in range(0, len(texts), AT_ONCE):
                sets += [s for s in shingle_sets(texts[i : i + AT_ONCE].to_pylist(), words, any_case) if len(s)]
            return [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], [s.tobytes() for s in sets]

        return run

    made = over_batches(texts, make, "key binary, shingles binary")
    wanted = made.join(members.select("key", "n", "sketch"), "key")
    return wanted.select("key", "n", "sketch", "shingles").dropDuplicates(["key"])


def _with_ends(pairs: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    for end in ("a", "b"):
        named = nodes.select(F.col("key").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in columns))
        pairs = pairs.join(named, end)
    return pairs


def confirmed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; sketches are asked first."""

    def by_sketch():
        def run(a, b, left, right, a_size, b_size):
            left, right = (
                np.frombuffer(b"".join(c.to_pylist()), np.uint32).reshape(-1, REGISTERS)
                for c in (left, right)
            )
            keep = pa.array(may_link(left, right, a_size.to_numpy(), b_size.to_numpy(), percent))
            return a.filter(keep), b.filter(keep)

        return run

    both = _with_ends(pairs, nodes, ["sketch", "n"]).select("a", "b", "a_sketch", "b_sketch", "a_n", "b_n")
    pairs = over_batches(both, by_sketch, "a binary, b binary")

    def by_sets():
        def run(a, b, left, right):
            keep = []
            for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            return a.filter(keep), b.filter(keep)

        return run

    both = _with_ends(pairs, nodes, ["shingles"]).select("a", "b", "a_shingles", "b_shingles")
    return over_batches(both, by_sets, "a binary, b binary")


def _comparable(percent: int, x: str, y: str):
    """Sets whose sizes alone allow the threshold."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _met(rest: DataFrame, group: str, blocks, stray_blocks, columns: list[str], parts: int) -> DataFrame:
    """Every meeting of a block of a group's nodes with a block of its strays.

    Strays are the nodes outside the component `main`. `part` gathers meetings for one call.
    """
    own, own_stray = F.pmod(F.xxhash64("key"), blocks), F.pmod(F.xxhash64("key"), stray_blocks)
    wanted = [group, "key", "n", "component", *columns]
    members = rest.select(
        *wanted,
        F.lit(False).alias("stray"),
        own.alias("m"),
        F.explode(F.sequence(F.lit(0).cast("long"), stray_blocks - 1)).alias("s"),
    )
    strays = rest.filter("component != main").select(
        *wanted,
        F.lit(True).alias("stray"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("m"),
        own_stray.alias("s"),
    )
    return members.union(strays).withColumn("part", F.pmod(F.xxhash64(group, "m", "s"), F.lit(parts)))


def _calls(groups: DataFrame, sizes, each: int) -> int:
    """How many calls the meetings of all groups are dealt to, so that one holds about `each`."""
    least = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = groups.agg(F.sum(sizes).cast("double")).first()[0] or 0
    return max(least, math.ceil(total / each))


class _Meetings:
    """The rows of one call in the order of their meetings."""

    def __init__(self, table: pa.Table, group: str):
        names = table[group].to_pylist()
        number = {n: i for i, n in enumerate(sorted(set(names)))}
        where = [np.array([number[n] for n in names])] + [table[c].to_numpy() for c in ("m", "s")]
        order = np.lexsort(where)
        table = table.take(pa.array(order))
        self.n = table["n"].to_numpy()
        self.stray = np.array(table["stray"].to_pylist(), bool)
        self.keys, self.components = table["key"].to_pylist(), table["component"].to_pylist()
        of: dict = {}
        self.label = np.array([of.setdefault(c, len(of)) for c in self.components])
        blobs = b"".join(table["sketch"].to_pylist())
        self.sketch = np.frombuffer(blobs, np.uint32).reshape(-1, REGISTERS)
        self.table = table
        self.starts = np.flatnonzero(changes(*(w[order] for w in where)))

    def links(self, percent: int, similar=None):
        """(stray, other) places that join two components, in the order they are found.

        `similar(stray, others)` says which of some others are linked; without it, estimates that
        pass are enough.
        """
        n = self.n
        for a, b in zip(self.starts, np.append(self.starts[1:], len(n)), strict=True):
            label = self.label[a:b].copy()
            right = np.flatnonzero(~self.stray[a:b])
            for x in np.flatnonzero(self.stray[a:b]):
                others = right[label[right] != label[x]]
                small, large = np.minimum(n[a + x], n[a + others]), np.maximum(n[a + x], n[a + others])
                others = others[small * 100 >= large * percent]
                if len(others):
                    own, theirs = self.sketch[a + x][None, :], self.sketch[a + others]
                    others = others[may_link(own, theirs, n[a + x], n[a + others], percent)]
                if len(others) and similar is not None:
                    others = others[similar(a + x, a + others)]
                if len(others):
                    joined, first = np.unique(label[others], return_index=True)
                    for y in others[first]:
                        yield a + x, a + y
                    label[np.isin(label, joined)] = label[x]


_PAIRS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _pairs(pairs) -> pa.Table:
    pairs = sorted({tuple(sorted(p)) for p in pairs})
    return pa.table([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], schema=_PAIRS)


def _families(met: DataFrame, percent: int) -> DataFrame:
    """Pairs of components (a, b) that connect those with estimates that pass."""

    def run(table: pa.Table) -> pa.Table:
        m = _Meetings(table, "band")
        return _pairs((m.components[x], m.components[y]) for x, y in m.links(percent))

    return met.groupBy("part").applyInArrow(run, "a binary, b binary").distinct()


def _joining_links(met: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes (a, b), confirmed on their full sets, that join components of a family."""

    def run(table: pa.Table) -> pa.Table:
        m = _Meetings(table, "family")
        sets = [np.frombuffer(s, np.uint64) for s in m.table["shingles"].to_pylist()]

        def similar(x: int, others: np.ndarray) -> np.ndarray:
            own = sets[x]
            values = np.concatenate([sets[y] for y in others])
            at = np.minimum(np.searchsorted(own, values), len(own) - 1)
            sizes = m.n[others]
            both = np.add.reduceat((own[at] == values).astype(np.int64), np.cumsum(sizes) - sizes)
            return 100 * both >= percent * (len(own) + sizes - both)

        return _pairs((m.keys[x], m.keys[y]) for x, y in m.links(percent, similar))

    return met.groupBy("part").applyInArrow(run, "a binary, b binary").distinct()


def _links_between(shared: DataFrame, sets: DataFrame, links: DataFrame, percent: int, folder: str) -> DataFrame:
    """The links that join components which the stars have left apart."""
    found = components(links).withColumnsRenamed({"node": "key"})
    named = (
        shared.filter("size > 2")
        .join(found, "key", "left")
        .select("band", "key", "n", "size", F.coalesce("component", "key").alias("component"))
    )
    named = stored(named, f"{folder}/named")
    mains = named.groupBy("band", "component").agg(F.count("key").alias("nodes")).groupBy("band").agg(
        F.max_by("component", F.struct("nodes", "component")).alias("main"),
        (F.sum("nodes") - F.max("nodes")).alias("strays"),
        F.sum("nodes").alias("all_nodes"),
    )
    mains = stored(mains.filter("strays > 0"), f"{folder}/mains")
    rest = join_unique(named, mains, "band").join(sets.select("key", "sketch"), "key")
    # a bucket of many nodes is met by its strays only, however few blocks those fill
    blocks, stray_blocks = (F.ceil(F.col(c) / SKETCHES) for c in ("all_nodes", "strays"))
    parts = _calls(mains, F.col("all_nodes") * stray_blocks + F.col("strays") * blocks, MET_ROWS)
    near = stored(_families(_met(rest, "band", blocks, stray_blocks, ["sketch"], parts), percent), f"{folder}/near")
    families = components(near).select(F.col("node").alias("component"), F.col("component").alias("family"))

    nodes = sets.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
    members = stored(nodes.join(families, "component"), f"{folder}/members")
    sizes = members.groupBy("family", "component").agg(F.count("key").alias("nodes"), F.sum("n").alias("shingles"))
    sizes = sizes.groupBy("family").agg(
        F.max_by("component", F.struct("nodes", "component")).alias("main"),
        F.sum("nodes").alias("all_nodes"),
        F.sum("shingles").alias("all_shingles"),
        (F.sum("nodes") - F.max("nodes")).alias("strays"),
    )
    sizes = stored(sizes, f"{folder}/sizes")
    rest = join_unique(members, sizes, "family")
    blocks = F.greatest(F.ceil(F.col("all_nodes") / MEMBERS), F.ceil(F.col("all_shingles") / BLOCK_SHINGLES))
    stray_blocks = F.greatest(F.ceil(blocks * F.col("strays") / F.col("all_nodes")), F.lit(1).cast("long"))
    both_ways = F.col("all_shingles") * stray_blocks * (1 + F.col("strays") / F.col("all_nodes") * blocks / stray_blocks)
    parts = _calls(sizes, both_ways, MET_SHINGLES)
    return _joining_links(_met(rest, "family", blocks, stray_blocks, ["sketch", "shingles"], parts), percent)


def near_duplicates(
    docs: DataFrame,
    percent: int = CORPUS_PERCENT,
    words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    any_case: bool = False,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_hash (xxhash64 of the text) of every row.

    Sets are linked if 100 * intersection >= `percent` * union; component_id is the smallest id
    reachable over links, and a row is kept if that is its own. Columns to `carry` follow; none of
    them may have one of these names. `any_case` compares all letters without case, not A-Z only.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark)
    signed = stored(signatures(docs, words, id_col, text_col, carry, any_case), f"{folder}/signatures")
    carried = [F.col(f"_c{i}") for i in range(len(carry))]
    linkable = signed.filter("n > 0 AND doc_id IS NOT NULL")
    nodes = stored(
        linkable.groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        ),
        f"{folder}/nodes",
    )
    bands = _bands(nodes)
    buckets = bands.groupBy("band").agg(F.min("key").alias("least"), F.min_by("n", "key").alias("least_n"), F.count("key").alias("size"))
    shared = stored(join_unique(bands, buckets.filter("size > 1"), "band"), f"{folder}/shared")
    star = (
        shared.filter((F.col("key") != F.col("least")) & _comparable(percent, "n", "least_n"))
        .select(F.col("least").alias("a"), F.col("key").alias("b"))
        .distinct()
    )
    members = nodes.join(shared.select("key").distinct(), "key", "left_semi").select("key", "rep", "n", "sketch")
    sets = stored(_sets(members, docs, words, id_col, text_col, any_case), f"{folder}/sets")
    links = stored(confirmed(star, sets, percent), f"{folder}/star")
    between = _links_between(shared, sets, links, percent, folder)
    all_links = stored(links.union(between), f"{folder}/links")
    found = components(all_links)

    named = nodes.select("key", "rep").join(found.withColumnRenamed("node", "key"), "key")
    least = named.groupBy("component").agg(F.min("rep").alias("least_rep"))
    labelled = join_unique(named, least, "component").select("key", "least_rep")
    labels = nodes.select("key", "rep").join(labelled, "key", "left").select(
        "key", F.coalesce("least_rep", "rep").alias("component_id")
    )
    linked = join_unique(linkable, labels, "key").select("doc_id", "n", "component_id", "text_hash", *carried)
    alone = signed.filter("n = 0 OR doc_id IS NULL").select(
        "doc_id", "n", F.col("doc_id").alias("component_id"), "text_hash", *carried
    )
    return linked.union(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_hash",
        *(c.alias(name) for c, name in zip(carried, carry, strict=True)),
    )
