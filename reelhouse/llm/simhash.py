"""Near-duplicate documents by SimHash, found through deletion variants of fingerprint halves.

Fingerprint. A text's three-word shingles (lower-cased A-Z, repeats included, joined by a space)
are hashed by XXH64 with seed 42; a bit of the fingerprint is 1 if it is set in over half of the
hashes. Fingerprints that differ in at most `DISTANCE` = 3 bits are linked.

Search. A fingerprint is cut into two halves of 32 bits only, so of two linked fingerprints one
half differs by at most one bit. What is indexed is each distinct value of a half, once for every
bit left out (one wildcard): equality on such a variant brings together exactly the values that
are equal but for that bit, two at most, so no bucket of the index can be hot, whatever the
documents. Two kinds of meetings follow, and no others can hold a link:

* `same`: the fingerprints that share a value of a half;
* `next`: those of one value against those of a value that differs in one bit.

A meeting of two fingerprints is verified where it is found. Larger ones are verified by the
fingerprints' bits in tasks that hold many meetings. A meeting of more than `DIRECT` fingerprints
(one half may be shared by a third of all) is indexed once more by one-wildcard variants of the
quarters of its other half: one quarter differs by at most one bit, and what such a variant leaves
open is 18 bits, so its fingerprints are at most 2^18 and are verified by asking for each of the
possible differences, which is linear in their number. Nothing is capped; of the links of a
meeting only those are returned that join its groups.

Equal fingerprints are one node from the start. Components of the links give each document the
smallest id reachable.

Cases: null and empty texts and texts without words have the fingerprint zero and are linked like
any other; a text of fewer than three words has one shingle, the whole sequence. A row with a null
id takes part with its fingerprint, never names a component, and gets the smallest id that its
fingerprint reaches (null if there is none). Rows that share an id, equal or not, each get a row.
Very long texts are counted in pieces of `AT_ONCE` shingles. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.components import components, stored
from reelhouse.llm.rows import chosen, over_batches
from reelhouse.operators.joins import join_unique
from reelhouse.session import scratch_dir

WORDS = 3
SEED = 42
DISTANCE = 3
#: Shingles counted at a time, fingerprints of a meeting that are compared directly, and rows of
#: meetings given to one call.
AT_ONCE = 1 << 18
DIRECT = 1024
PER_CALL = 1 << 17

_LOW = (1 << 32) - 1


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle, in the order of the text."""
    split = (text or "").encode().lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(split), xxhash.xxh64_intdigest
    if len(split) <= words:
        return np.array([digest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes)[: 1 - words].tolist(), ends[words - 1 :].tolist()
    hashes = (digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True))
    return np.fromiter(hashes, np.uint64, len(first))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, the highest bit first."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), AT_ONCE):
        some = hashes[i : i + AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, words: int = WORDS) -> int:
    hashes = shingle_hashes(text, words)
    return int.from_bytes(np.packbits(2 * bit_counts(hashes) > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (64 bits as a signed number) of every row."""

    def make():
        def run(ids, texts):
            values = [fingerprint(t, words) for t in texts.to_pylist()]
            return ids, np.array(values, np.uint64).view(np.int64)

        return run

    source = chosen(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return over_batches(source, make, "doc_id long, fingerprint long")


def half_values(nodes: DataFrame) -> DataFrame:
    """(half, value, one, size): each distinct value of a half, how many fingerprints have it, and
    the least of these."""
    both = F.array(
        F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("fingerprint", 32).alias("value")),
        F.struct(F.lit(1).alias("half"), F.col("fingerprint").bitwiseAND(_LOW).alias("value")),
    )
    return (
        nodes.select("fingerprint", F.explode(both).alias("at"))
        .groupBy("at.half", "at.value")
        .agg(F.min("fingerprint").alias("one"), F.count(F.lit(1)).alias("size"))
    )


def neighbours(values: DataFrame) -> DataFrame:
    """(half, wildcard, a, b): values of a half that differ in the bit `wildcard` alone.

    Every value is indexed by its 32 variants with one bit left out. A variant fits in a number
    beside the half and the place of the bit, and holds two values at most.
    """
    bit = F.expr("shiftleft(1L, wildcard)")
    variants = values.select(
        "half", "value", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("wildcard")
    ).select(
        (F.col("value").bitwiseAND(F.bitwise_not(bit)) + F.expr("shiftleft(wildcard * 2L + half, 32)")).alias("variant"),
        F.when(F.col("value").bitwiseAND(bit) == 0, 1).otherwise(2).alias("side"),
    )
    found = variants.groupBy("variant").agg(F.bit_or("side").alias("sides")).filter("sides = 3")
    place = F.shiftright("variant", 32)
    low = F.col("variant").bitwiseAND(_LOW)
    return found.select(
        place.bitwiseAND(1).cast("int").alias("half"),
        F.shiftright(place, 1).cast("int").alias("wildcard"),
        low.alias("a"),
    ).withColumn("b", F.col("a").bitwiseOR(bit))


def meetings(values: DataFrame, folder: str) -> DataFrame:
    """(half, wildcard, a, b, a_one, b_one, size): values whose fingerprints have to be compared.

    A wildcard of -1 stands for one value with several fingerprints, where b is a.
    """
    pairs = stored(neighbours(values), f"{folder}/neighbours")
    for end in ("a", "b"):
        named = values.select(
            "half", F.col("value").alias(end), F.col("one").alias(f"{end}_one"), F.col("size").alias(f"{end}_size")
        )
        pairs = pairs.join(named, ["half", end])
    columns = ["half", "wildcard", "a", "b", "a_one", "b_one"]
    pairs = pairs.select(*columns, (F.col("a_size") + F.col("b_size")).alias("size"))
    same = values.filter("size > 1").select(
        "half",
        F.lit(-1).alias("wildcard"),
        F.col("value").alias("a"),
        F.col("value").alias("b"),
        F.col("one").alias("a_one"),
        F.col("one").alias("b_one"),
        "size",
    )
    return stored(pairs.unionByName(same), f"{folder}/meetings")


def _members(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """(half, wildcard, variant, size, fingerprint): the fingerprints of each meeting."""
    ends = met.select(
        "half",
        "wildcard",
        F.col("a").alias("variant"),
        "size",
        F.explode(F.array_distinct(F.array("a", "b"))).alias("value"),
    )
    keyed = nodes.select(
        "fingerprint",
        F.explode(F.array(F.lit(0), F.lit(1))).alias("half"),
    ).withColumn(
        "value",
        F.when(F.col("half") == 0, F.shiftrightunsigned("fingerprint", 32)).otherwise(
            F.col("fingerprint").bitwiseAND(_LOW)
        ),
    )
    return keyed.join(ends, ["half", "value"]).drop("value")


class Groups:
    """Which members of a meeting are joined already."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
        """Join members x[i] and y[i], and return the pairs that did join two groups."""
        apart = np.flatnonzero(self.label[x] != self.label[y])
        if not len(apart):
            return []
        x, y = x[apart], y[apart]
        ends = np.sort(np.stack([self.label[x], self.label[y]], axis=1), axis=1)
        ends, first = np.unique(ends, axis=0, return_index=True)
        parent: dict[int, int] = {}

        def root(v: int) -> int:
            while parent.get(v, v) != v:
                parent[v] = v = parent.get(parent[v], parent[v])
            return v

        joined = []
        for (a, b), i in zip(ends.tolist(), first.tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
                joined.append((int(x[i]), int(y[i])))
        moved = np.arange(len(self.label))
        for v in list(parent):
            moved[v] = root(v)
        self.label = moved[self.label]
        return joined


def _masks(bits: list[int], most: int) -> list[int]:
    """All numbers with one to `most` of some bits."""
    masks = {0}
    for _ in range(most):
        masks |= {m | 1 << b for m in masks for b in bits}
    return sorted(masks - {0})


def links_directly(members: np.ndarray) -> list[tuple[int, int]]:
    """Places of linked members that join all groups of a meeting, by comparing a member with the
    others at a time."""
    groups, out = Groups(len(members)), []
    for i in range(len(members) - 1):
        near = np.flatnonzero(np.bitwise_count(members[i + 1 :] ^ members[i]) <= DISTANCE) + i + 1
        out += groups.join(np.full(len(near), i), near)
    return out


def links_by_masks(members: np.ndarray, free: list[int]) -> list[tuple[int, int]]:
    """As `links_directly` for sorted members that differ in the bits `free` alone, by looking up
    every possible difference."""
    groups, out = Groups(len(members)), []
    for mask in _masks(free, DISTANCE):
        other = members ^ np.uint64(mask)
        at = np.minimum(np.searchsorted(members, other), len(members) - 1)
        x = np.flatnonzero(members[at] == other)
        x = x[x < at[x]]
        out += groups.join(x, at[x])
    return out


def links_of(members: np.ndarray, free: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs of linked fingerprints that join all groups of a meeting."""
    members = np.unique(members)
    if free is None or len(members) <= DIRECT:
        pairs = links_directly(members)
    else:
        pairs = links_by_masks(members, free)
    return [(int(members[x]), int(members[y])) for x, y in pairs]


def _solved(rows: DataFrame, key: list[str], parts: int, free=None) -> DataFrame:
    """(a, b): the links that join groups of each meeting named by `key`."""

    def run(table: pa.Table) -> pa.Table:
        names = [table[c].to_numpy() for c in key]
        prints = table["fingerprint"].to_numpy().view(np.uint64)
        order = np.lexsort(names)
        names, prints = [n[order] for n in names], prints[order]
        new = np.zeros(len(prints), bool)
        new[0] = True
        for n in names:
            new[1:] |= n[1:] != n[:-1]
        starts = np.flatnonzero(new)
        found = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(prints)], strict=True):
            bits = free(*(int(n[a]) for n in names)) if free else None
            found += links_of(prints[a:b], bits)
        made = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"a": pa.array(made[:, 0]), "b": pa.array(made[:, 1])})

    part = F.pmod(F.xxhash64(*key), F.lit(parts))
    named = rows.select(*key, "fingerprint", part.alias("part"))
    return named.groupBy("part").applyInArrow(run, "a long, b long").distinct()


def _quarter_variants(large: DataFrame) -> DataFrame:
    """Members of large meetings by the one-wildcard variants of the quarters of their other half."""
    other = F.when(F.col("half") == 0, F.col("fingerprint").bitwiseAND(_LOW)).otherwise(
        F.shiftrightunsigned("fingerprint", 32)
    )
    places = large.withColumn("other", other).withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(31))))
    quarter = F.when(F.col("place") < 16, F.col("other").bitwiseAND(0xFFFF)).otherwise(
        F.shiftright("other", 16)
    )
    return places.withColumn(
        "rest", quarter.bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, place % 16)")))
    )


def open_bits(half: int, wildcard: int, variant: int, place: int, rest: int) -> list[int]:
    """The bits in which members of such a variant may differ."""
    low = 32 if half == 1 else 0  # where the other half begins
    own = [] if wildcard < 0 else [32 * (1 - half) + wildcard]
    quarter = place // 16
    return [*own, low + place, *range(low + 16 * (1 - quarter), low + 16 * (2 - quarter))]


def links(nodes: DataFrame, folder: str) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are linked."""
    least = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = stored(half_values(nodes), f"{folder}/values")
    met = meetings(values, folder)
    pairs = met.filter("size = 2 AND wildcard >= 0 AND bit_count(a_one ^ b_one) <= 3").select(
        F.col("a_one").alias("a"), F.col("b_one").alias("b")
    )
    sizes = met.filter("size > 2 OR wildcard < 0").agg(
        F.sum(F.when(F.col("size") <= DIRECT, F.col("size"))), F.sum(F.when(F.col("size") > DIRECT, F.col("size")))
    ).first()
    small = _members(met.filter(f"(size > 2 OR wildcard < 0) AND size <= {DIRECT}"), nodes)
    name = ["half", "wildcard", "variant"]
    found = pairs.union(_solved(small, name, max(least, -(-(sizes[0] or 0) // PER_CALL))))
    if sizes[1]:
        large = _quarter_variants(_members(met.filter(f"size > {DIRECT}"), nodes))
        parts = max(least, -(-32 * sizes[1] // PER_CALL))
        found = found.union(_solved(large, [*name, "place", "rest"], parts, open_bits))
    return stored(found.distinct(), f"{folder}/links")


def near_duplicates(
    docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    folder = scratch_dir(docs.sparkSession)
    printed = stored(fingerprints(docs, words, id_col, text_col), f"{folder}/fingerprints")
    nodes = stored(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("rep")), f"{folder}/nodes")
    found = components(links(nodes.select("fingerprint"), folder))
    named = nodes.join(found, nodes["fingerprint"] == found["node"], "left").select(
        "fingerprint", "rep", F.coalesce("component", "fingerprint").alias("component")
    )
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = join_unique(named.select("fingerprint", "component"), least, "component")
    labels = stored(labels.select("fingerprint", "component_id"), f"{folder}/labels")
    return join_unique(printed, labels, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
