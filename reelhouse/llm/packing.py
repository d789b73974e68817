"""Best-fit packing of documents into sequences, with conflicts.

Method: pieces are taken longest first. The open bins of a shard are ordered by the room they
have left, and each carries a bitmap of its sources and one of its duplicate clusters. A piece
goes into the bin with the least room that is enough and whose bitmaps hold neither its source
nor its cluster: the search starts at the first bin with enough room and goes on to the next one
until a bin is compatible. If none is, a new bin is opened.

Documents longer than a bin are cut into pieces; all but the last fill bins of their own. Pieces
are dealt to shards of about `SHARD` by a hash of their id, so a hot source or cluster is spread
over all shards, and a shard's search is bounded by its size. Bitmaps number the sources and
clusters of their shard.

With `percent`, the clusters are the groups of near duplicates of that similarity, found on the
lower-cased texts; texts without words, and all texts without `percent`, have the digest of the
lower-cased text as theirs. Rows with a null id take part under a hash of their text, and rows that
share an id are told apart by theirs, so a copy conflicts whatever its id is.

Scale: one pass over the texts stores (id, length, source, cluster), and one shuffle deals these to
shards; with `percent` they travel with the signatures of the search for near duplicates. Packing
itself shuffles no texts. The result is the same for any number of partitions.

Cases: a null or empty text is one piece of length 0, which takes a place in a bin like any
other. Null sources conflict with each other, and so do null clusters. Null ids come first in
ties. Repeated rows are packed one by one; equal rows have the same cluster, so they never share
a bin. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.components import stored
from reelhouse.llm.near_duplicates import near_duplicates
from reelhouse.session import scratch_dir

#: Room of a bin, in bytes of text, and pieces for each shard.
CAPACITY = 8192
SHARD = 1024
RESULT = (
    "doc_id long, piece long, start long, length long, bin_id long, place long, room_left long"
)


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """The bin of each (length, source number, cluster number), in the given order."""
    open_bins: list[tuple[int, int]] = []  # (room, bin), least room first
    sources: list[int] = []
    clusters: list[int] = []
    chosen = []
    for length, source, cluster in pieces:
        s, c = 1 << source, 1 << cluster
        at = bisect_left(open_bins, (length, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (sources[b] & s or clusters[b] & c):
                break
            at += 1
        if at < len(open_bins):
            room, b = open_bins.pop(at)
            sources[b] |= s
            clusters[b] |= c
        else:
            room, b = capacity, len(sources)
            sources.append(s)
            clusters.append(c)
        insort(open_bins, (room - length, b))
        chosen.append(b)
    return chosen


def _pack_shard(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(
            zip(*(table[n].to_pylist() for n in ("doc_id", "piece", "start", "length", "source", "cluster")), strict=True),
            key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[5] or "", r[4] or ""),
        )
        source_of: dict = {}
        cluster_of: dict = {}
        numbered = [
            (r[3], source_of.setdefault(r[4], len(source_of)), cluster_of.setdefault(r[5], len(cluster_of)))
            for r in rows
        ]
        bins = best_fit(numbered, capacity)
        filled: dict[int, int] = {}
        places, count = [], {}
        for (length, _, _), b in zip(numbered, bins, strict=True):
            filled[b] = filled.get(b, 0) + length
            places.append(count.setdefault(b, 0))
            count[b] += 1
        base = table["shard"][0].as_py() << 20
        return pa.table(
            {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "piece": pa.array([r[1] for r in rows], pa.int64()),
                "start": pa.array([r[2] for r in rows], pa.int64()),
                "length": pa.array([r[3] for r in rows], pa.int64()),
                "bin_id": pa.array([base + b for b in bins], pa.int64()),
                "place": pa.array(places, pa.int64()),
                "room_left": pa.array([capacity - filled[b] for b in bins], pa.int64()),
            }
        )

    return run


def measured(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, cluster=None, percent: int | None = None
) -> DataFrame:
    """(doc_id, size, source, cluster) of every row."""
    text, own = docs[f"`{text_col}`"], docs[f"`{id_col}`"].cast("long")
    if cluster is None and percent is None:
        cluster = F.md5(F.lower(text))
    elif cluster is None:  # of texts without a word; all others get that of their group
        cluster = F.when(~text.rlike(r"[^\x20\x09-\x0D]"), F.md5(text))
    rows = docs.select(
        own.alias("own"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size"),
        docs[f"`{source_col}`"].cast("string").alias("source"),
        cluster.alias("cluster"),
        *([] if percent is None else [F.coalesce(own, F.xxhash64(F.lower(text))).alias("doc_id"), text.alias("text")]),
    )
    if percent is not None:
        near = near_duplicates(rows, percent, carry=["own", "size", "source", "cluster"], any_case=True)
        group = F.when(F.col("n_shingles") > 0, F.col("component_id").cast("string"))
        rows = near.withColumn("cluster", F.coalesce(group, "cluster"))
    return rows.select(F.col("own").alias("doc_id"), "size", "source", "cluster")


def pieces_of(rows: DataFrame, capacity: int) -> DataFrame:
    """One row per piece of measured rows, with its place in the document."""
    last = F.greatest(F.ceil(F.col("size") / capacity) - 1, F.lit(0))
    return (
        rows.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("start", F.col("piece") * capacity)
        .withColumn("length", F.least(F.col("size") - F.col("start"), F.lit(capacity)))
        .drop("size")
    )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster=None,
    percent: int | None = None,
) -> DataFrame:
    """One row of `RESULT` per piece; pieces with one bin_id form a sequence, in order of place.

    Lengths are bytes of text. `cluster`: a string column that is equal for duplicates; by
    default a digest of the lower-cased text. `percent`: near duplicates of that similarity are
    duplicates too.
    """
    rows = measured(docs, id_col, text_col, source_col, cluster, percent)
    rows = stored(rows, f"{scratch_dir(docs.sparkSession)}/measured")
    pieces = pieces_of(rows, capacity)
    n = rows.agg(F.sum(F.greatest(F.ceil(F.col("size") / capacity), F.lit(1)))).first()[0] or 0
    shards = max(1, -(-int(n) // shard_pieces))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards))
    return pieces.withColumn("shard", spread).groupBy("shard").applyInArrow(_pack_shard(capacity), RESULT)
