"""Token ids in binary files, compressed by pair grammars that can be read at any place.

Method: documents are put in ascending id order by a range shuffle, encoded with the tokenizers
library, every distinct piece of text once (`pieces`), and cut into blocks of about `BLOCK` ids. In
each block the frequent pairs of neighbouring ids are replaced by new symbols, again and again
(Re-Pair): a round takes all pairs that occur often enough, gives overlapping places to the more
frequent pair, and stops mattering when it shortens the block by less than `MIN_GAIN`. A block is
stored as its symbols, its rules and the expansion length of each rule, so that any stretch of ids
is decoded from the symbols that cover it alone.

File format: a Parquet folder with one row per block.

| column | holds |
| --- | --- |
| part, block, offset | range partition, block in it, ids before the block in the partition |
| doc_ids, sizes | the block's documents and their id counts, end id included |
| terminals | symbols from this number on are rules |
| symbols, rules, lengths | little-endian unsigned 32-bit: symbols; rule pairs; expansion lengths |

Parquet is written and read by Spark, so a block appears only when its task has committed, and
any store that Spark reaches will do.

Scale: one range shuffle of the texts. The number of ids before a document is the sum over the
partitions before (one row each), over the blocks before in the partition (stored), and over the
documents before in the block.

Cases: a null or empty text has only its end id. Null ids come first, rows that share an id are
ordered by a hash of the text, and repeated rows follow each other. An empty table gives an empty
folder that reads as no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelhouse.llm.blobs import changes
from reelhouse.llm.chunks import library
from reelhouse.llm.pieces import runs, text_ids
from reelhouse.llm.rows import bucket_count, chosen, over_batches

BLOCK = 1 << 18
MIN_GAIN = 0.02
#: A pair must occur so often in a block to be worth a rule.
MIN_PAIRS = 8
#: Pairs are counted by so many bits of a hash first.
BIN_BITS = 18
#: Stretches of one block that are decoded together.
AT_ONCE = 1024
FILE_DDL = (
    "part int, block int, offset long, n_ids long, doc_ids array<long>, sizes binary, "
    "terminals long, symbols binary, rules binary, lengths binary"
)


def in_order(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of so many bits in ascending order, and the place of each; the left of equal ones first.
    Key and place are sorted as one number if they fit into it."""
    place_bits = len(keys).bit_length()
    if bits + place_bits > 64:
        places = np.argsort(keys, kind="stable")
        return keys[places], places
    both = np.sort(keys << np.uint64(place_bits) | np.arange(len(keys), dtype=np.uint64))
    return both >> np.uint64(place_bits), (both & np.uint64((1 << place_bits) - 1)).astype(np.int64)


def replace_pairs(s: np.ndarray, first: int, min_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: the shorter sequence, and the replaced pairs in the order of their symbols."""
    bits = int(s.max()).bit_length()
    key = s[:-1].astype(np.uint64) << np.uint64(bits) | s[1:]
    bin_of = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BIN_BITS)).astype(np.int32)
    often = np.flatnonzero((np.bincount(bin_of, minlength=1 << BIN_BITS) >= min_pairs)[bin_of])
    ordered, places = in_order(key[often], 2 * bits)
    starts = np.flatnonzero(changes(ordered))
    counts = np.diff(np.append(starts, len(ordered)))
    good = counts >= min_pairs
    pairs = ordered[starts[good]]
    if not len(pairs):
        return s, np.zeros((0, 2), np.uint32)
    rank_of = np.empty(len(pairs), np.int64)
    rank_of[np.argsort(-counts[good], kind="stable")] = np.arange(len(pairs))
    worst = np.int64(len(pairs))
    rank = np.full(len(s) + 1, worst)  # place i + 1 holds the pair at i
    rank_of_run = np.full(len(starts), worst)
    rank_of_run[good] = rank_of
    rank[often[places] + 1] = np.repeat(rank_of_run, counts)
    here = rank[1:-1]
    # a place yields to a better neighbour, and of equal ones the left wins
    at = np.flatnonzero((here < worst) & (here < rank[:-2]) & (here <= rank[2:]))
    chosen_rank = here[at]
    used = np.bincount(chosen_rank, minlength=len(pairs))
    worth = used[chosen_rank] > 2  # a rule costs three numbers
    at, chosen_rank = at[worth], chosen_rank[worth]
    kept = np.flatnonzero(used > 2)
    symbol = np.zeros(len(pairs), np.int64)
    symbol[kept] = np.arange(len(kept))
    by_rank = np.empty(len(pairs), np.uint64)
    by_rank[rank_of] = pairs
    out = s.copy()
    out[at] = (first + symbol[chosen_rank]).astype(np.uint32)
    stay = np.ones(len(s), bool)
    stay[at + 1] = False
    made = by_rank[kept]
    pair_rows = np.stack([made >> np.uint64(bits), made & np.uint64((1 << bits) - 1)], axis=1)
    return out[stay], pair_rows.astype(np.uint32)


def compress(ids: np.ndarray, terminals: int, min_pairs: int = MIN_PAIRS, min_gain: float = MIN_GAIN):
    """Symbols, rules (left, right) and expansion lengths of a sequence of ids."""
    s, rules, n = ids.astype(np.uint32), [], 0
    while len(s) > 1:
        shorter, made = replace_pairs(s, terminals + n, min_pairs)
        gain = len(s) - len(shorter)
        s = shorter
        rules.append(made)
        n += len(made)
        if gain <= min_gain * len(s):
            break
    rules = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return s, rules, rule_lengths(rules, terminals)


def rule_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many ids each rule stands for; a rule's parts come before it."""
    lengths = np.ones(len(rules), np.int64)
    known = np.zeros(len(rules), bool)
    plain = rules < terminals
    parts = np.where(plain, 0, rules.astype(np.int64) - terminals)
    while not known.all():
        ready = ~known & (known[parts] | plain).all(axis=1)
        lengths[ready] = np.where(plain[ready], 1, lengths[parts[ready]]).sum(axis=1)
        known |= ready
    return lengths.astype(np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids that symbols stand for."""
    s = symbols.astype(np.int64)
    while True:
        rule = s >= terminals
        if not rule.any():
            return s.astype(np.uint32)
        place = np.cumsum(1 + rule) - 1 - rule
        out = np.empty(len(s) + int(rule.sum()), np.int64)
        out[place] = np.where(rule, rules[np.where(rule, s - terminals, 0), 0], s) if len(rules) else s
        out[place[rule] + 1] = rules[s[rule] - terminals, 1]
        s = out


def expand_block(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    """The ids of a whole block: every rule is expanded once, and taken wherever it stands."""
    s = symbols.astype(np.int64)
    rule = np.flatnonzero(s >= terminals)
    number = s[rule] - terminals
    sizes = rule_lengths(rules, terminals).astype(np.int64)
    ids = expand(np.arange(terminals, terminals + len(rules)), rules, terminals)
    start, taken = len(ids) + np.arange(len(s)), np.ones(len(s), np.int64)
    start[rule], taken[rule] = (np.cumsum(sizes) - sizes)[number], sizes[number]
    return runs(np.concatenate([ids, symbols]), start, taken)[0]


def stretch(symbols, rules, lengths, terminals: int, start: int, n: int) -> np.ndarray:
    """Ids start to start + n of a block, expanding only the symbols that cover them."""
    s = symbols.astype(np.int64)
    size = np.ones(len(s), np.int64)
    rule = s >= terminals
    size[rule] = lengths[s[rule] - terminals]
    ends = np.cumsum(size)
    a, b = np.searchsorted(ends, [start, start + n - 1], side="right")
    before = int(ends[a] - size[a])
    return expand(symbols[a : b + 1], rules, terminals)[start - before :][:n]


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> None:
    """Write the ids of every row, with `end_id` behind each text, as files in id order."""
    source = chosen(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    partitions = bucket_count(docs)
    ordered = source.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def make():
        encode, part = text_ids(path), TaskContext.get().partitionId()
        terminals = max(library(path).get_vocab_size(), end_id + 1)
        state = {"offset": 0, "block": 0}

        def record(docs: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> tuple:
            packed = [a.astype("<u4").tobytes() for a in compress(ids, terminals)]
            sizes = sizes.astype("<u4").tobytes()
            row = part, state["block"], state["offset"], len(ids), docs.to_pylist(), sizes, terminals, *packed
            state["offset"] += len(ids)
            state["block"] += 1
            return row

        def run(docs, texts):
            rows, at = [], 0  # `at`: documents in blocks
            held, held_sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64)
            for ids, sizes in encode(texts):
                held = np.concatenate([held, np.insert(ids, np.cumsum(sizes), end_id)])
                held_sizes = np.concatenate([held_sizes, sizes + 1])
                ends = np.cumsum(held_sizes)
                done = taken = 0
                while (n := int(np.searchsorted(ends, taken + block)) + 1) <= len(ends):
                    to = int(ends[n - 1])
                    rows.append(record(docs[at : at + n - done], held[taken:to], held_sizes[done:n]))
                    at, done, taken = at + n - done, n, to
                held, held_sizes = held[taken:], held_sizes[done:]
            if len(held_sizes):
                rows.append(record(docs[at:], held, held_sizes))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(10)]

        return run

    over_batches(ordered, make, FILE_DDL).write.parquet(folder)


def part_starts(files: DataFrame) -> DataFrame:
    """Ids before each range partition: a running sum over one row per partition."""
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start and ids (little-endian unsigned 32-bit) of every document in the files."""
    return _read(spark, folder, "ids binary", lambda ids: (ids.tobytes(),))


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    return _read(
        spark,
        folder,
        "n_tokens long, ids_crc32 long",
        lambda ids: (len(ids), zlib.crc32(ids.tobytes())),
    )


def _read(spark: SparkSession, folder: str, schema: str, finish) -> DataFrame:
    files = spark.read.schema(FILE_DDL).parquet(folder)
    placed = files.join(F.broadcast(part_starts(files)), "part")  # the blocks stay where they are

    def make():
        def run(*columns):
            rows = []
            for record in zip(*(c.to_pylist() for c in columns), strict=True):
                base, offset, ids, sizes, terminals, symbols, rules = record
                sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
                rules = np.frombuffer(rules, "<u4").reshape(-1, 2)
                whole = expand_block(np.frombuffer(symbols, "<u4"), rules, terminals).astype("<u4", copy=False)
                ends = np.cumsum(sizes)
                for doc, a, b in zip(ids, (ends - sizes).tolist(), ends.tolist(), strict=True):
                    rows.append((doc, base + offset + a, *finish(whole[a:b])))
            n = 2 + len(schema.split(","))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(n)]

        return run

    wanted = placed.select("start", "offset", "doc_ids", "sizes", "terminals", "symbols", "rules")
    return over_batches(wanted, make, f"doc_id long, start long, {schema}")


def read_stretches(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """doc_id, start, n and ids (little-endian unsigned 32-bit) of stretches of documents.

    `wanted`: rows (doc_id, start, n), `start` counted in the ids of the document. A stretch that
    goes on behind the document ends with it. The place of a document comes from the files' index
    columns, and of a block only the symbols that cover a stretch are expanded, which their
    expansion lengths tell. Every row of the files with that id answers; null ids have no answer.

    Up to `AT_ONCE` stretches of a block are decoded together, so that its symbols travel once for
    these and no list grows with the number of stretches.
    """
    files = spark.read.schema(FILE_DDL).parquet(folder)

    def places():
        def run(parts, blocks, ids, sizes):
            rows = []
            for part, block, docs, packed in zip(*(c.to_pylist() for c in (parts, blocks, ids, sizes)), strict=True):
                n = np.frombuffer(packed, "<u4").astype(np.int64)
                before = (np.cumsum(n) - n).tolist()
                rows += [(part, block, d, at, size) for d, at, size in zip(docs, before, n.tolist(), strict=True)]
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(5)]

        return run

    index = over_batches(
        files.select("part", "block", "doc_ids", "sizes"), places, "part int, block int, doc_id long, at long, size long"
    )
    asked = wanted.select(F.col("doc_id").cast("long"), F.col("start").cast("long"), F.col("n").cast("long"))
    found = asked.join(index, "doc_id").withColumn(
        "n", F.least("n", F.greatest(F.col("size") - F.col("start"), F.lit(0).cast("long")))
    )
    order = Window.partitionBy("part", "block").orderBy("doc_id", "at", "start", "n")
    asked_of = (
        found.withColumn("group", F.floor((F.row_number().over(order) - 1) / AT_ONCE))
        .groupBy("part", "block", "group")
        .agg(F.collect_list(F.struct("doc_id", "start", "n", "at")).alias("asked"))
    )
    blocks = files.select("part", "block", "terminals", "symbols", "rules", "lengths")

    def decode():
        def run(*columns):
            rows = []
            for asked, terminals, symbols, rules, lengths in zip(*(c.to_pylist() for c in columns), strict=True):
                symbols, lengths = np.frombuffer(symbols, "<u4"), np.frombuffer(lengths, "<u4")
                rules = np.frombuffer(rules, "<u4").reshape(-1, 2)
                for a in asked:
                    ids = b""
                    if a["n"] > 0:
                        made = stretch(symbols, rules, lengths, terminals, a["at"] + a["start"], a["n"])
                        ids = made.astype("<u4").tobytes()
                    rows.append((a["doc_id"], a["start"], a["n"], ids))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(4)]

        return run

    joined = blocks.join(asked_of, ["part", "block"]).select("asked", "terminals", "symbols", "rules", "lengths")
    return over_batches(joined, decode, "doc_id long, start long, n long, ids binary")
