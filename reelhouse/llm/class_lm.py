"""Scores of texts under a Brown class-based bigram model, learned from the same corpus.

Method. P(word | previous) = P(class | class of the previous) * P(word | class). The `HEAD` most
frequent words are put into `CLASSES` classes by exchange: every word moves to the class in which
the likelihood of the class bigrams is greatest, until a pass moves none. Each other word then
joins the class that its neighbours among the head words make most likely, the same exchange step
with the classes held still. With `every_word` that is the start only: rounds over the whole
vocabulary and all bigrams follow, in which every word moves to the class that the classes of all
its neighbours make most likely. Words take turns by a bit of their hash, half of them in a round,
as neighbours that move together mislead each other. The rounds end when two of them, one of each
half, raise the log-likelihood of the class bigrams by `TOLERANCE` a token or less.
The start and the end of a text are a class of their own, and all
unknown words are one type in one class. Words seen once stand in for unknown ones: what follows
them and what they follow gives the transitions from and to the class of unknown words.
Transitions are smoothed with the overall frequency of the next class, so for every previous word
the probabilities of all known words, the end and the unknown type add up to one.

Scale. Texts are tokenised once, into chunks of ids with a dictionary of word hashes, stored as
Parquet. A chunk sends each of its words once to the word's bucket and gets its count and class
back in the same order; contexts of rare words travel as one byte each. So the shuffles carry
distinct words of chunks instead of tokens. The driver gets the head (`HEAD` words), their bigram
table (at most (`HEAD` + 1) squared cells), class totals and transitions, all of fixed size.
For the rounds the chunks are stored once more, as a table bucketed by chunk, so that a round
shuffles no texts: the words in turn go to their buckets with the counted classes of their
neighbours, as numbers that buckets have given them, and their classes come back.

Cases: a null or empty text has the end token alone. Texts are held out if crc32 of the id as
text is divisible by 10, so rows with a null id (as an empty text, crc32 0) are. Repeated rows
count and are scored one by one. Without training texts every token is unknown and scores 0.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.blobs import Layout, changes
from reelhouse.llm.components import stored
from reelhouse.llm.rows import bucket_count, chosen, over_batches
from reelhouse.session import scratch_dir
from reelhouse.sources.store import delete

HEAD = 512
CLASSES = 32
PASSES = 20
#: Log-likelihood a token that two rounds over all words must gain for more to follow.
TOLERANCE = 0.02
#: Of the words without a neighbour in the head, one in so many begins in any class.
DEALT = 2
#: Words of a bucket that are moved together.
MOVED_AT_ONCE = 1 << 16
#: Weight of the overall class frequencies in a row of transitions.
SMOOTHING = 20.0
#: Bytes of text and documents in a chunk, at which the next one begins.
CHUNK_BYTES = 1 << 23
CHUNK_DOCS = 2048
#: Hash of the end of a text; words never have it.
END = 0
CORPUS_DDL = "chunk long, words binary, counts binary, docs binary, ids binary"
ROWS_DDL = "chunk long, bucket int, kind byte, words binary, ids binary"
ANSWER_DDL = "chunk long, bucket int, counts binary, classes binary"
SCORED_DDL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
    "emission double, classes binary, pairs binary"
)
NUMBERED_DDL = (
    "chunk long, docs binary, ids binary, sizes binary, places binary, turns binary, counts binary, classes binary"
)
MET_DDL = "chunk long, bucket int, cells binary, pairs binary"
MOVED_DDL = "chunk long, bucket int, half int, classes binary"
DOCS = Layout(doc="i8", known="u1", held="u1", n="u4")
WORDS = Layout(hash="u8", count="u4")
_WORDS, _CONTEXTS = 1, 2


def squeezed(numbers: np.ndarray, kind: str = "<u4") -> bytes:
    """Unsigned numbers, their low bytes first and their high bytes last, compressed."""
    width = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expanded(packed: bytes, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def held_out(doc) -> bool:
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 10 == 0


class _Local(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def chunk_of(docs: list, texts: list[str | None], buckets: int):
    """A chunk's dictionary by bucket and hash, its documents, and its tokens as places in it."""
    local, tokens, sizes = _Local(), [], []
    local[None] = 0  # the end
    get = local.__getitem__
    for t in texts:
        words = (t or "").encode().lower().split()
        tokens.append(np.fromiter(map(get, words), np.uint32, len(words)))
        tokens.append(np.zeros(1, np.uint32))
        sizes.append(len(words) + 1)
    hashes = np.fromiter(
        (END if w is None else xxhash.xxh3_64_intdigest(w) or 1 for w in local), np.uint64, len(local)
    )
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    place = np.empty(len(order), np.uint32)
    place[order] = np.arange(len(order))
    ids = place[np.concatenate(tokens)]
    held = np.array([held_out(d) for d in docs], bool)
    trained = np.bincount(ids[np.repeat(~held, sizes)], minlength=len(order))
    table = {
        "doc": np.array([0 if d is None else d for d in docs], np.int64),
        "known": np.array([d is not None for d in docs]),
        "held": held,
        "n": np.array(sizes),
    }
    return hashes[order], trained, bucket[order], table, ids


def _chunks(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of `CORPUS_DDL`, one per chunk."""

    def make():
        state = {"next": TaskContext.get().partitionId() << 24}

        def run(ids, texts):
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(lengths, dtype=np.int64) // CHUNK_BYTES + (np.arange(len(ids)) // CHUNK_DOCS << 32)
            rows = []
            starts = np.flatnonzero(changes(group))
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(ids)).tolist(), strict=True):
                chunk, state["next"] = state["next"], state["next"] + 1
                hashes, trained, _, table, tokens = chunk_of(
                    ids[a:b].to_pylist(), texts[a:b].to_pylist(), buckets
                )
                rows.append((chunk, hashes.tobytes(), squeezed(trained), DOCS.pack(table), squeezed(tokens)))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(5)]

        return run

    return over_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, CORPUS_DDL)


def _by_bucket(hashes: np.ndarray, buckets: int):
    """(bucket, start, end) of a chunk's words, which are in the order of their buckets."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    starts = np.flatnonzero(changes(bucket)).tolist()
    return zip(bucket[starts].tolist(), starts, [*starts[1:], len(bucket)], strict=True)


def _words(corpus: DataFrame, buckets: int) -> DataFrame:
    """Rows of `ROWS_DDL`: the words of each chunk for each bucket, with their counts."""

    def make():
        def run(chunks, words, counts):
            rows = []
            for chunk, w, c in zip(chunks.to_pylist(), words.to_pylist(), counts.to_pylist(), strict=True):
                columns = {"hash": np.frombuffer(w, np.uint64), "count": expanded(c)}
                for bucket, a, b in _by_bucket(columns["hash"], buckets):
                    blob = WORDS.pack({n: values[a:b] for n, values in columns.items()})
                    rows.append((chunk, bucket, _WORDS, blob, None))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(5)]

        return run

    return over_batches(corpus.select("chunk", "words", "counts"), make, ROWS_DDL)


class Corpus:
    """One chunk, unpacked."""

    def __init__(self, docs: bytes, ids: bytes, words: bytes = b""):
        self.hashes = np.frombuffer(words, np.uint64)
        self.docs = DOCS.unpack([docs])
        self.ids = expanded(ids)
        self.sizes = self.docs["n"].astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.trained = np.repeat(self.docs["held"] == 0, self.sizes)

    def neighbours(self, values: np.ndarray, start: int) -> np.ndarray:
        """The value before each token; `start` before the first of a text."""
        before = np.empty_like(values)
        before[1:] = values[:-1]
        before[self.ends - self.sizes] = start
        return before


def head_places(hashes: np.ndarray, head: np.ndarray) -> np.ndarray:
    """1 + the place of each hash in the sorted head, 0 for the end and -1 for others."""
    if not len(head):
        return np.where(hashes == END, 0, -1)
    at = np.minimum(np.searchsorted(head, hashes), len(head) - 1)
    return np.where(hashes == END, 0, np.where(head[at] == hashes, at + 1, -1))


def _head_pairs(corpus: DataFrame, head: np.ndarray) -> DataFrame:
    """(cell, n): bigrams of head words and text ends in training texts, summed."""
    side = len(head) + 1

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                c = Corpus(*row)
                place = head_places(c.hashes, head)[c.ids]
                before = c.neighbours(place, 0)
                both = c.trained & (place >= 0) & (before >= 0)
                total += np.bincount(before[both] * side + place[both], minlength=side * side)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    return corpus.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _flog(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, classes: int, passes: int = PASSES) -> np.ndarray:
    """Classes 1 to `classes` of words 1 to n by exchange; word 0 is alone in class 0.

    `pairs`: bigram counts. Words begin in the order given, dealt to the classes in turn.
    """
    n = len(pairs) - 1
    of = np.zeros(n + 1, np.int64)
    of[1:] = 1 + np.arange(n) % classes
    member = np.zeros((n + 1, classes + 1))
    member[np.arange(n + 1), of] = 1
    pairs = pairs.astype(np.float64)
    table = member.T @ pairs @ member
    for _ in range(passes):
        moved = 0
        for w in range(1, n + 1):
            a, own = of[w], pairs[w, w]
            out, into = pairs[w] @ member, pairs[:, w] @ member
            table[a] -= out
            table[:, a] -= into
            table[a, a] += own
            out[a] -= own
            into[a] -= own
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            gain = (_flog(table + out[None, :]) - _flog(table)).sum(axis=1)
            gain += (_flog(table + into[:, None]) - _flog(table)).sum(axis=0)
            here = np.diag(table)
            gain -= _flog(here + out) + _flog(here + into) - _flog(here)
            gain += _flog(here + out + into + own)
            gain -= _flog(rows + out.sum() + own) - _flog(rows)
            gain -= _flog(columns + into.sum() + own) - _flog(columns)
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            moved += best != a
            member[w, a], member[w, best] = 0, 1
            of[w] = best
            out[a] += own if best == a else 0
            into[a] += own if best == a else 0
            if best != a:
                out[best] += own
                into[best] += own
            table[best] += out
            table[:, best] += into
            table[best, best] -= own
        if not moved:
            break
    return of


def class_table(pairs: np.ndarray, of: np.ndarray, classes: int) -> np.ndarray:
    member = np.zeros((len(of), classes + 1))
    member[np.arange(len(of)), of] = 1
    return member.T @ pairs @ member


def joining_weights(table: np.ndarray) -> np.ndarray:
    """(side and class of a neighbour, class): what a neighbour adds to a word's class."""
    smooth = table + 0.5
    right = np.log(smooth / smooth.sum(axis=1, keepdims=True))  # class, next class
    left = np.log(smooth / smooth.sum(axis=0, keepdims=True))  # class before, class
    return np.concatenate([left, right.T])


def _contexts(
    corpus: DataFrame, head: np.ndarray, of: np.ndarray, side: int, buckets: int
) -> DataFrame:
    """Per chunk and bucket, the neighbours' classes of each word that is not in the head.

    In `words`: how many neighbours each word of the bucket has; in `ids`: their classes, one
    byte each, with `side` added for those on the right.
    """

    def make():
        def run(chunks, *columns):
            rows = []
            for chunk, *row in zip(chunks.to_pylist(), *(c.to_pylist() for c in columns), strict=True):
                c = Corpus(*row)
                place = head_places(c.hashes, head)
                cls = np.where(place >= 0, of[np.maximum(place, 0)], -1).astype(np.int16)[c.ids]
                before = c.neighbours(cls, 0)
                after = np.append(cls[1:], -1)  # a word is never the last token
                rare = c.trained & (place[c.ids] < 0)
                owner = np.concatenate([c.ids[rare], c.ids[rare]])
                cell = np.concatenate([before[rare], np.where(after[rare] >= 0, after[rare] + side, -1)])
                owner, cell = owner[cell >= 0], cell[cell >= 0]
                order = np.argsort(owner, kind="stable")
                owner, cell = owner[order], cell[order].astype(np.uint8)
                counts = np.bincount(owner, minlength=len(c.hashes)).astype(np.uint32)
                ends = np.cumsum(counts)
                for bucket, a, b in _by_bucket(c.hashes, buckets):
                    cells = cell[ends[a] - counts[a] : ends[b - 1]]
                    if len(cells):
                        rows.append((chunk, bucket, _CONTEXTS, squeezed(counts[a:b]), cells.tobytes()))
            return list(zip(*rows, strict=True)) if rows else [[] for _ in range(5)]

        return run

    return over_batches(corpus.select("chunk", "docs", "ids", "words"), make, ROWS_DDL)


def _tallied(table: pa.Table):
    """Of a bucket: the chunks in order, their word lists, the distinct words, the word of each
    entry, and the total counts."""
    kinds, chunks, blobs = (table[c].to_pylist() for c in ("kind", "chunk", "words"))
    listed = sorted((c, b) for k, c, b in zip(kinds, chunks, blobs, strict=True) if k == _WORDS)
    entries = WORDS.unpack([b for _, b in listed])
    distinct, word = np.unique(entries["hash"], return_inverse=True)
    total = _sums(word, entries["count"].astype(np.int64), len(distinct))
    return [c for c, _ in listed], [len(b) // WORDS.width for _, b in listed], distinct, word, total


def _sums(group: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """The sum of the values of each group, in whole numbers."""
    out = np.zeros(groups, np.int64)
    np.add.at(out, group, values)
    return out


def _count_words(head: int):
    """Per bucket: its most frequent words, with the bucket's sums in the first row."""

    def run(table: pa.Table) -> pa.Table:
        _, _, distinct, _, total = _tallied(table)
        order = np.lexsort((distinct.view(np.int64), -total))  # ties as the driver orders them
        order = order[(total[order] > 0) & (distinct[order] != END)][:head]
        n, v = [int(total.sum())], [int((total > 0).sum())]
        rest = [0] * len(order)
        return pa.table(
            {
                "hash": pa.array([0, *distinct[order].view(np.int64).tolist()], pa.int64()),
                "count": pa.array([0, *total[order].tolist()], pa.int64()),
                "n": pa.array(n + rest, pa.int64()),
                "v": pa.array(v + rest, pa.int64()),
            }
        )

    return run


def _answer(head: np.ndarray, of: np.ndarray, weights: np.ndarray, numbered: bool = False):
    """Per bucket: count and class of each chunk's words, in the chunk's order, and if `numbered`
    the steps from one word's number in the bucket to the next one's."""

    def run(table: pa.Table) -> pa.Table:
        chunks, sizes, distinct, word, total = _tallied(table)
        place = head_places(distinct, head)
        classes = weights.shape[1] - 1
        votes = np.zeros(len(distinct) * len(weights), np.int64)
        ends = np.cumsum(sizes)
        at = {c: (e - n, e) for c, n, e in zip(chunks, sizes, ends.tolist(), strict=True)}
        for row in table.filter(pc.equal(table["kind"], _CONTEXTS)).to_pylist():
            a, b = at[row["chunk"]]
            owner = np.repeat(word[a:b], expanded(row["words"]))
            cell, n = np.unique(owner * len(weights) + np.frombuffer(row["ids"], np.uint8), return_counts=True)
            votes[cell] += n
        votes = votes.reshape(len(distinct), len(weights))
        if numbered:
            joined = _dealt(distinct, classes)
            for a in range(0, len(joined), MOVED_AT_ONCE):
                part = votes[a : a + MOVED_AT_ONCE]
                some = part.any(axis=1)
                joined[a : a + MOVED_AT_ONCE][some] = _likeliest(part[some], weights)
        else:
            joined = 1 + np.argmax((votes @ weights)[:, 1:], axis=1) if classes else 1
        cls = np.where(place >= 0, of[np.maximum(place, 0)], joined).astype(np.uint8)
        counts = total[word]
        spans = [at[c] for c in chunks]
        made = {
            "chunk": pa.array(chunks, pa.int64()),
            "bucket": pa.array([table["bucket"][0].as_py()] * len(chunks), pa.int32()),
            "counts": pa.array([squeezed(counts[a:b], "<i8") for a, b in spans], pa.binary()),
            "classes": pa.array([cls[word[a:b]].tobytes() for a, b in spans], pa.binary()),
            "totals": pa.array(
                [_sums(cls, total, classes + 1).tobytes()]
                + [b""] * (len(chunks) - 1),
                pa.binary(),
            ),
        }
        if numbered:
            made["places"] = pa.array([squeezed(_steps(word[a:b])) for a, b in spans], pa.binary())
        return pa.table(made)

    return run


def _likeliest(votes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The class that the neighbours of each word make most likely, the first of equal ones."""
    return 1 + np.argmax(np.round(votes @ weights, 6)[:, 1:], axis=1)


def _dealt(hashes: np.ndarray, classes: int) -> np.ndarray:
    """Where words without a neighbour in the head begin: in the first class, but one in `DEALT` in
    any, without which rounds could not tell words apart that only meet each other."""
    any_class = 1 + (hashes >> np.uint64(44)) % np.uint64(classes)
    return np.where((hashes >> np.uint64(41)) % np.uint64(DEALT) == 0, any_class, 1).astype(np.int64)


def _steps(numbers: np.ndarray) -> np.ndarray:
    """Unsigned steps from each number to the next one, the first from 0; `np.cumsum` goes back."""
    return np.diff(numbers.astype(np.uint32), prepend=np.uint32(0))


def _number(buckets: int):
    """Per chunk: the row of `NUMBERED_DDL`, from its row of the corpus and its answers."""

    def run(corpus: pa.Table, answers: pa.Table) -> pa.Table:
        row = corpus.to_pylist()[0]
        hashes = np.frombuffer(row["words"], np.uint64)
        parts = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        places = [np.cumsum(expanded(p["places"]), dtype=np.uint32) for p in parts]
        counts = [expanded(p["counts"], "<i8") for p in parts]
        sizes = np.bincount((hashes % np.uint64(buckets)).astype(np.int64), minlength=buckets)
        made = (
            row["chunk"],
            row["docs"],
            row["ids"],
            squeezed(sizes),
            squeezed(_steps(np.concatenate(places))),
            np.packbits((hashes >> np.uint64(40)).astype(np.uint8) & 1).tobytes(),
            squeezed(np.concatenate(counts), "<i8"),
            b"".join(p["classes"] for p in parts),
        )
        return pa.table([[v] for v in made], schema=_NUMBERED)

    return run


_NUMBERED = pa.schema(
    [(name, pa.int64() if kind == "long" else pa.binary()) for name, kind in map(str.split, NUMBERED_DDL.split(", "))]
)


class _Numbered(Corpus):
    """One chunk with the numbers, turns and present classes of its words, the first of which is
    the end; `moved` are its rows of `MOVED_DDL`, at most one for a bucket and half."""

    def __init__(self, row: dict, moved: list[dict]):
        super().__init__(row["docs"], row["ids"])
        self.classes = np.frombuffer(row["classes"], np.uint8).copy()
        self.turns = np.unpackbits(np.frombuffer(row["turns"], np.uint8), count=len(self.classes))
        self.counts = expanded(row["counts"], "<i8")
        self.bucket_ends = np.cumsum(expanded(row["sizes"]), dtype=np.int64)
        self.places = np.cumsum(expanded(row["places"]), dtype=np.uint32)
        for half in {r["half"] for r in moved}:
            rows = sorted((r["bucket"], r["classes"]) for r in moved if r["half"] == half)
            self.classes[self.in_turn(half)] = np.frombuffer(b"".join(c for _, c in rows), np.uint8)

    def in_turn(self, half: int) -> np.ndarray:
        """Places of the words that move in rounds of a half: all with training tokens in any chunk
        but the end."""
        return 1 + np.flatnonzero((self.counts[1:] > 0) & (self.turns[1:] == half))


def _meet(half: int, side: int):
    """Per chunk: a row with its class bigrams, and per bucket the words in turn with how often
    each has a neighbour of a class: cell k for class k before it, `side` + k for class k after it."""
    width = 2 * side

    def run(chunk: pa.Table, moved: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        c = _Numbered(row, moved.to_pylist())
        tokens = c.classes.astype(np.int64)[c.ids]
        before, t = c.neighbours(tokens, 0), c.trained
        pairs = np.bincount(before[t] * side + tokens[t], minlength=side * side)
        words = c.in_turn(half)
        mine = np.zeros(len(c.classes), bool)
        mine[words] = True
        at = np.flatnonzero(t & mine[c.ids])
        base = c.ids[at].astype(np.int64) * width
        keys = np.concatenate([base + before[at], base + side + tokens[at + 1]])  # the end follows the last word
        keys = np.sort(keys.astype(np.uint32) if len(c.classes) * width < 1 << 32 else keys)
        first = np.flatnonzero(changes(keys))
        ns, keys = np.diff(np.append(first, len(keys))), keys[first]
        owner = keys // width
        cells = keys - owner * width
        each = np.bincount(owner, minlength=len(c.classes))[words]
        made = [(row["chunk"], -1, b"", pairs.astype(np.int64).tobytes())]
        cut = np.searchsorted(words, np.append(0, c.bucket_ends)).tolist()
        ends = np.append(0, np.cumsum(each)).tolist()
        places = c.places[words]
        for bucket, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if a < b:
                x, y = ends[a], ends[b]
                parts = [b - a], _steps(places[a:b]), each[a:b], cells[x:y], ns[x:y]
                made.append((row["chunk"], bucket, squeezed(np.concatenate(parts)), None))
        columns = zip(zip(*made, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)
        return pa.table([pa.array(v, k) for v, k in columns], names=["chunk", "bucket", "cells", "pairs"])

    return run


def _move(half: int, weights: np.ndarray):
    """Per bucket: the words in turn in the classes that their neighbours make most likely."""
    width = len(weights)

    def run(met: pa.Table) -> pa.Table:
        parts = [expanded(b) for b in met["cells"].to_pylist()]
        sizes = [int(p[0]) for p in parts]
        words = np.concatenate(
            [np.cumsum(p[1 : n + 1], dtype=np.uint32) for p, n in zip(parts, sizes, strict=True)]
        ).astype(np.int64)
        each = np.concatenate([p[n + 1 : 2 * n + 1] for p, n in zip(parts, sizes, strict=True)])
        found = [p[2 * n + 1 :].reshape(2, -1) for p, n in zip(parts, sizes, strict=True)]
        keys = np.repeat(words * width, each) + np.concatenate([f[0] for f in found])
        ns = np.concatenate([f[1] for f in found])
        best = np.zeros(int(words.max()) + 1, np.uint8)
        for a in range(0, len(best), MOVED_AT_ONCE):
            b = min(a + MOVED_AT_ONCE, len(best))
            inside = (keys >= a * width) & (keys < b * width)
            votes = np.bincount(keys[inside] - a * width, ns[inside], (b - a) * width).reshape(-1, width)
            best[a:b] = _likeliest(votes, weights)
        ends = np.cumsum(sizes).tolist()
        spans = zip([0, *ends[:-1]], ends, strict=True)
        return pa.table(
            {
                "chunk": met["chunk"],
                "bucket": met["bucket"],
                "half": pa.array([half] * len(sizes), pa.int32()),
                "classes": pa.array([best[words[a:b]].tobytes() for a, b in spans], pa.binary()),
            }
        )

    return run


def likelihood(table: np.ndarray) -> float:
    """What the classes add to the log-likelihood of the bigrams, from the class bigrams."""
    return float(_flog(table).sum() - _flog(table.sum(axis=0)).sum() - _flog(table.sum(axis=1)).sum())


def _exchanged(chunks: DataFrame, classes: int, folder: str) -> tuple[DataFrame, np.ndarray]:
    """Rows of `MOVED_DDL` with the classes of all words after the rounds, and the class bigrams."""
    spark, side, turn = chunks.sparkSession, classes + 1, 0
    moved = [spark.createDataFrame([], MOVED_DDL)] * 2
    kept, kept_table, best = moved, None, -np.inf
    while True:
        now, half = f"{folder}/met-{turn}", turn % 2
        by_chunk = moved[0].union(moved[1]).groupBy("chunk")
        met = stored(chunks.groupBy("chunk").cogroup(by_chunk).applyInArrow(_meet(half, side), MET_DDL), now)
        table = _class_pairs(met, side)
        if half == 0:
            value = likelihood(table)
            if value > best:
                kept, kept_table = list(moved), table
            if value <= best + TOLERANCE * table.sum():
                delete(spark, now)
                return kept[0].union(kept[1]), kept_table
            best = value
        weights = joining_weights(table)
        chosen_classes = met.filter("bucket >= 0").groupBy("bucket").applyInArrow(_move(half, weights), MOVED_DDL)
        moved[half] = stored(chosen_classes, f"{folder}/moved-{turn}")
        delete(spark, now)
        turn += 1


def _tag(n: int, v: int, class_totals: np.ndarray, numbered: bool = False):
    """Per chunk: its texts as classes with what does not depend on transitions, and in the first
    row the bigrams of classes in training texts, with words seen once as unknown words too.

    The answers are those of the start, or if `numbered` rows of `MOVED_DDL` for numbered chunks.
    """
    classes = len(class_totals) - 1
    unknown, side = classes + 1, classes + 2

    def run(corpus: pa.Table, answers: pa.Table) -> pa.Table:
        row = corpus.to_pylist()[0]
        if numbered:
            c = _Numbered(row, answers.to_pylist())
            count, cls = c.counts, c.classes.astype(np.int64)
        else:
            c = Corpus(row["docs"], row["ids"])
            parts = sorted(answers.select(["bucket", "counts", "classes"]).to_pylist(), key=lambda r: r["bucket"])
            count = np.concatenate([expanded(p["counts"], "<i8") for p in parts])
            cls = np.frombuffer(b"".join(p["classes"] for p in parts), np.uint8).astype(np.int64)
        cls = np.where(count > 0, cls, unknown)
        base = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
        emission = np.zeros(len(count))
        inside = (count > 0) & (cls > 0)
        emission[inside] = np.log10(count[inside] / class_totals[cls[inside]])
        tokens = cls[c.ids]
        before = c.neighbours(tokens, 0)
        pairs = np.zeros((side, side), np.int64)
        t = c.trained
        np.add.at(pairs, (before[t], tokens[t]), 1)
        once = (count == 1)[c.ids] & t & (tokens != 0)
        after_once = c.neighbours(once.astype(np.int64), 0).astype(bool) & t
        np.add.at(pairs, (before[once], np.full(int(once.sum()), unknown)), 1)
        np.add.at(pairs, (np.full(int(after_once.sum()), unknown), tokens[after_once]), 1)
        pairs[unknown, unknown] += int((once & after_once).sum())
        starts = c.ends - c.sizes

        def sums(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values[c.ids], starts)

        docs, known = c.docs["doc"].tolist(), c.docs["known"].tolist()
        packed = tokens.astype(np.uint8).tobytes()
        return pa.table(
            {
                "doc_id": pa.array([d if k else None for d, k in zip(docs, known, strict=True)], pa.int64()),
                "held_out": pa.array(c.docs["held"].astype(bool)),
                "n_tokens": pa.array(c.sizes),
                "n_known": pa.array(sums((count > 0).astype(np.int64))),
                "base_score": pa.array(sums(base)),
                "emission": pa.array(sums(emission)),
                "classes": pa.array(
                    [packed[a:b] for a, b in zip(starts.tolist(), c.ends.tolist(), strict=True)], pa.binary()
                ),
                "pairs": pa.array([pairs.tobytes()] + [None] * (len(docs) - 1), pa.binary()),
            }
        )

    return run


def _class_pairs(tagged: DataFrame, side: int) -> np.ndarray:
    """The class bigrams of all chunks, summed in the tasks and then cell by cell."""

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(blob, np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    summed = tagged.filter("pairs IS NOT NULL").select("pairs").mapInArrow(run, "cell long, n long")
    return _square(summed.groupBy("cell").agg(F.sum("n").alias("n")), side)


def _square(cells: DataFrame, side: int) -> np.ndarray:
    """A table of fixed size from its cells."""
    out = np.zeros(side * side, np.int64)
    for row in cells.collect():
        out[row.cell] = row.n
    return out.reshape(side, side)


def transitions(pairs: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log10 P(class | class before); the last class is that of unknown words.

    `pairs` holds what words seen once add to the last row and column on top of the real bigrams.
    """
    overall = pairs[:-1].sum(axis=0).astype(np.float64)
    overall[-1] += 1
    overall /= overall.sum()
    rows = pairs.sum(axis=1, keepdims=True)
    # a class that was never seen holds no words, so its zero probability is never used
    return np.log10(np.maximum((pairs + smoothing * overall) / (rows + smoothing), 1e-300))


def text_scores(
    docs: DataFrame,
    head_words: int = HEAD,
    classes: int = CLASSES,
    id_col: str = "doc_id",
    text_col: str = "text",
    every_word: bool = False,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    `every_word`: all words and bigrams take part in the exchange, after that of the head words.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark)
    buckets = bucket_count(docs)
    source = chosen(docs, doc_id=id_col, text=text_col)
    corpus = stored(_chunks(source, buckets), f"{folder}/corpus")
    words = _words(corpus, buckets)

    counted = stored(
        words.drop("ids")
        .groupBy("bucket")
        .applyInArrow(_count_words(head_words), "hash long, count long, n long, v long"),
        f"{folder}/counted",
    )
    sums = counted.agg(F.sum("n"), F.sum("v")).first()
    n, v = int(sums[0] or 0), int(sums[1] or 0)
    top = counted.filter("count > 0").orderBy(F.desc("count"), "hash").limit(head_words).collect()
    frequent = np.array([r["hash"] for r in top], np.int64).view(np.uint64)
    head = np.sort(frequent)
    pairs = _square(_head_pairs(corpus.select("docs", "ids", "words"), head), len(head) + 1)
    # the exchange begins with words in the order of their frequency
    by_count = np.concatenate([[0], np.searchsorted(head, frequent) + 1]).astype(np.int64)
    of = np.zeros(len(head) + 1, np.int64)
    of[by_count] = exchange(pairs[np.ix_(by_count, by_count)], classes)
    weights = joining_weights(class_table(pairs, of, classes))

    contexts = _contexts(corpus, head, of, classes + 1, buckets)
    answer_ddl = f"{ANSWER_DDL}, totals binary" + ", places binary" * every_word
    answers = stored(
        words.union(contexts).groupBy("bucket").applyInArrow(_answer(head, of, weights, every_word), answer_ddl),
        f"{folder}/answers",
    )
    if every_word:
        by_chunk = answers.select("chunk", "bucket", "counts", "classes", "places").groupBy("chunk")
        chunks = corpus.select("chunk", "docs", "ids", "words").groupBy("chunk").cogroup(by_chunk)
        name = f"chunks_{uuid.uuid4().hex}"
        chunks = _by_chunk(chunks.applyInArrow(_number(buckets), NUMBERED_DDL), buckets, name, f"{folder}/chunks")
        for old in ("corpus", "answers"):
            delete(spark, f"{folder}/{old}")
        answers, table = _exchanged(chunks, classes, folder)
        totals = table.sum(axis=0)
    else:
        chunks, totals = corpus.select("chunk", "docs", "ids"), _class_totals(answers, classes + 1)
        answers = answers.select("chunk", "bucket", "counts", "classes")
    tagged = stored(
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(_tag(n, v, totals, every_word), SCORED_DDL),
        f"{folder}/tagged",
    )
    if every_word:
        spark.sql(f"DROP TABLE {name}")
        delete(spark, f"{folder}/chunks")
    logs = transitions(_class_pairs(tagged, classes + 2))

    def make():
        def run(ids, held, n_tokens, n_known, base, emission, sequences):
            scores = []
            for e, s in zip(emission.to_pylist(), sequences.to_pylist(), strict=True):
                s = np.frombuffer(s, np.uint8)
                scores.append(e + float(logs[np.concatenate([[0], s[:-1]]), s].sum()))
            return ids, held, n_tokens, n_known, [n] * len(ids), base, scores

        return run

    columns = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "emission", "classes"]
    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return over_batches(tagged.select(*columns), make, schema)


def _by_chunk(chunks: DataFrame, buckets: int, name: str, folder: str) -> DataFrame:
    """Stored as a table that is bucketed by chunk, so that later groups of chunks need no shuffle."""
    chunks.write.format("parquet").option("path", folder).bucketBy(buckets, "chunk").saveAsTable(name)
    return chunks.sparkSession.table(name)


def _class_totals(answers: DataFrame, classes: int) -> np.ndarray:
    """Training tokens in each class, summed in the tasks and then class by class."""

    def run(batches):
        total = np.zeros(classes, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                total += np.frombuffer(blob, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes)), pa.array(total)], ["cell", "n"])

    summed = answers.filter(F.octet_length("totals") > 0).select("totals").mapInArrow(run, "cell long, n long")
    out = np.zeros(classes, np.int64)
    for row in summed.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row.cell] = row.n
    return out
