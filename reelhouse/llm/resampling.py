"""Importance resampling of documents towards a target distribution, over hashed word features.

Method. An untrained pre-tokenizer of the tokenizers library, a Regex Split, takes the words of
the lower-cased text (A-Z only) with their offsets. Windows over neighbouring offset pairs are the
features: every run of 1 to `MAX_RUN` words, joined by a space, repeats counted. A feature's bucket
is the CRC-32 of its UTF-8 bytes modulo `BUCKETS`. One pass stores each document's buckets (two
bytes a feature) and another sums them: S features of all documents, s of them in a bucket, and T
and t in the target. A bucket's gain is floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), a document's
weight the floored mean of its features' gains. Adding Gumbel noise drawn from a hash of the id and
taking the highest scores draws documents without replacement, in proportion to their weights.

Scale. Texts are read once; the second pass reads the stored buckets. Histograms are summed in the
tasks and then per bucket, so the driver gets `BUCKETS` counts at most, and every task the same
number of gains. Nothing is sorted as a whole: the distinct scores are whole numbers between fixed
bounds (the logarithms of counts and of 32-bit noise), so the number of documents above each score
is a small table. Only documents at or above the score of the last one drawn are ordered, and only
within their score, equal rows counted before. So no key can hold much of the ordering.

Cases: null and empty texts, and those without words, have no features and weight 0. The noise of
a row with a null id is that of the empty id; such rows come last among equal scores. Rows that
share an id share its noise, and take places one after the other by n_features and weight; rows
that are equal in all of these take one place each. Long texts are looked at in pieces of `PIECE`
characters, cut between words. An empty table gives no rows, an empty target has T = 0. Extra
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.components import stored
from reelhouse.llm.rows import chosen, over_batches
from reelhouse.operators.joins import join_unique
from reelhouse.session import scratch_dir

MAX_RUN = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
DRAW_PERCENT = 10
#: Characters of a long text that are looked at together, features whose buckets are kept, and
#: copies of a row that are written by one task.
PIECE = 1 << 20
KNOWN = 400_000
COPIES = 10_000
#: What lies between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@functools.lru_cache(maxsize=1)
def splitter():
    """The pre-tokenizer: words with their offsets, what lies between them removed."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(BETWEEN), "removed")


def _word_character(c: str) -> bool:
    return c >= "\x80" or c.isalnum()


def pieces(text: str, size: int = PIECE):
    """The text in pieces of about `size` characters that do not cut words."""
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text) and _word_character(text[end]) and _word_character(text[end - 1]):
            end += 1
        yield text[start:end]
        start = end


def features(text: str, offsets: list[tuple[int, int]], max_run: int = MAX_RUN) -> list[str]:
    """Every run of 1 to `max_run` words, joined by a space: windows over neighbouring offsets."""
    out = [text[a:b] for a, b in offsets]
    for n in range(2, max_run + 1):
        windows = zip(*(offsets[i:] for i in range(n)), strict=False)
        out += [" ".join(text[a:b] for a, b in window) for window in windows]
    return out


class FeatureBuckets(dict):
    """Feature to bucket, kept for features that come again."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        self[feature] = bucket = zlib.crc32(feature.encode()) % self.buckets
        return bucket


def feature_buckets(
    text: str | None, known: FeatureBuckets, max_run: int = MAX_RUN, size: int = PIECE
) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the buckets of its features."""
    split, words, out, last = splitter().pre_tokenize_str, 0, [], ""
    for piece in pieces((text or "").encode().lower().decode(), size):
        offsets = [o for _, o in split(piece)]
        words += len(offsets)
        if max_run > 1:  # runs reach over the cut
            carried = len(split(last))
            piece = f"{last} {piece}"
            offsets = [o for _, o in split(piece)]
            old = features(last, [o for _, o in split(last)], max_run) if carried else []
            made = list((Counter(features(piece, offsets, max_run)) - Counter(old)).elements())
            last = piece[offsets[-max_run + 1 :][0][0] :] if offsets else ""
        else:
            made = features(piece, offsets)
        out.append(np.fromiter(map(known.__getitem__, made), np.uint16, len(made)))
        if len(known) > KNOWN:
            known.clear()
    return words, np.concatenate(out) if out else np.zeros(0, np.uint16)


BUCKETED_DDL = "doc_id long, n_words long, n_features long, features binary"


def bucketed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_run: int = MAX_RUN,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, number of words and of features, and the features' buckets of every row."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError(f"buckets must be between 1 and 65536, not {buckets}")

    def make():
        known = FeatureBuckets(buckets)

        def run(ids, texts):
            words, counts, packed = [], [], []
            for t in texts.to_pylist():
                n, made = feature_buckets(t, known, max_run)
                words.append(n)
                counts.append(len(made))
                packed.append(made.tobytes())
            return ids, words, counts, packed

        return run

    source = chosen(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return over_batches(source, make, BUCKETED_DDL)


def histogram(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket. The driver gets `buckets` rows at most."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_py(), np.uint16), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    sums = rows.select("features").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of how much more often the target has each bucket, rounded down."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratios = (
        ((t + 1) * (s_all + b)) / ((s + 1) * (t_all + b))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    )
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """1000 times Gumbel noise from a hash of the id, rounded down."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int.from_bytes(hashlib.sha256(name.encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every bucketed row."""

    def make():
        def run(ids, words, counts, packed):
            weights = []
            for n, p in zip(counts.to_pylist(), packed, strict=True):
                total = int(gain[np.frombuffer(p.as_py(), np.uint16)].sum()) if n else 0
                weights.append(total // max(n, 1))
            drawn = [w + noise(d, seed) for w, d in zip(weights, ids.to_pylist(), strict=True)]
            return ids, words, counts, weights, drawn

        return run

    return over_batches(rows, make, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every stored row; rank is null if not drawn.

    Drawn are `percent` of the rows with `min_words` words, those with the highest scores, ties to
    the smaller id.
    """
    plain = ["doc_id", "n_features", "weight", "score"]
    able = F.col("n_words") >= min_words
    # the distinct scores, a few ten thousand whatever the number of rows
    from_top = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_score = scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    per_score = per_score.withColumn("upto", F.sum("n").over(from_top))
    quota = scored.agg(F.expr(f"{percent} * count_if(n_words >= {min_words}) div 100")).scalar()
    reached = per_score.select(
        "score", (F.col("upto") - F.col("n")).alias("above"), quota.alias("quota")
    ).filter("above < quota")
    at_top = join_unique(scored.withColumn("able", able), reached, "score", "left").withColumn(
        "candidate", F.col("able") & F.col("above").isNotNull()
    )
    at_top = stored(at_top, f"{scratch_dir(scored.sparkSession)}/candidates")
    rest = at_top.filter("NOT candidate").select(*plain, F.lit(None).cast("long").alias("rank"))
    equal = at_top.filter("candidate").groupBy(*plain, "above", "quota").agg(F.count(F.lit(1)).alias("copies"))
    before = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight").rowsBetween(
        Window.unboundedPreceding, -1
    )
    equal = equal.withColumn("first", F.col("above") + F.coalesce(F.sum("copies").over(before), F.lit(0)) + 1)
    last_piece = F.expr(f"(copies - 1) div {COPIES}")
    copies = (
        equal.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last_piece)))
        .withColumn("begin", F.col("piece") * COPIES)
        .withColumn("end", F.least(F.col("begin") + COPIES, F.col("copies")) - 1)
        .repartition(*plain, "piece")
        .withColumn("copy", F.explode(F.sequence("begin", "end")))
        .withColumn("place", F.col("first") + F.col("copy"))
    )
    drawn = copies.select(*plain, F.when(F.col("place") <= F.col("quota"), F.col("place")).alias("rank"))
    return drawn.unionByName(rest)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    max_run: int = MAX_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    percent: int = DRAW_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of `docs`."""
    folder = scratch_dir(docs.sparkSession)
    rows = stored(bucketed(docs, id_col, text_col, max_run, buckets), f"{folder}/features")
    wanted = target.withColumn("__id", F.lit(None).cast("long"))
    wanted = bucketed(wanted, "__id", target_text_col, max_run, buckets)
    gain = gains(histogram(rows, buckets), histogram(wanted, buckets))
    scored = stored(scores(rows, gain, seed), f"{folder}/scores")
    return ranked(scored, min_words, percent)


#: The same in SQL, over `documents` and `benchmark`; CRC-32 is taken byte by byte.
SQL = rf"""
WITH crc_table AS (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
    AS v FROM (SELECT unnest(range(256)) AS i)
), crc_list AS (
  SELECT list(v ORDER BY i) AS v FROM crc_table
), texts AS (
  SELECT 's' AS side, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 't', NULL, coalesce(text, '') FROM benchmark
), words AS (
  SELECT side, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), spelled AS (
  SELECT word, list_transform(range(octet_length(encode(word))),
    lambda k: ('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::BIGINT) AS bytes
  FROM (SELECT DISTINCT word FROM words)
), bucket_of AS (
  SELECT word, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, v[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)
    % {BUCKETS} AS bucket FROM spelled, crc_list
), counted AS (
  SELECT side, doc_id, bucket, count(*) AS n FROM words JOIN bucket_of USING (word) GROUP BY ALL
), sums AS (
  SELECT b.bucket, coalesce(sum(n) FILTER (side = 's'), 0)::DOUBLE AS s,
         coalesce(sum(n) FILTER (side = 't'), 0)::DOUBLE AS t
  FROM (SELECT unnest(range({BUCKETS})) AS bucket) b LEFT JOIN counted c ON b.bucket = c.bucket GROUP BY 1
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + {BUCKETS}) / ((s + 1) * (sum(t) OVER () + {BUCKETS}))))
    ::BIGINT AS g FROM sums
), weighted AS (
  SELECT doc_id, sum(n)::BIGINT AS n, floor(sum(n * g) / sum(n))::BIGINT AS w
  FROM counted JOIN gain USING (bucket) WHERE side = 's' GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight, coalesce(w, 0) + floor(-1000 * ln(-ln((
    ('0x' || left(sha256('{SEED}:' || d.doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weighted USING (doc_id)
), placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= {MIN_WORDS}
)
SELECT s.doc_id, s.n_features, s.weight, s.score,
       CASE WHEN place <= floor({DRAW_PERCENT} * n / 100) THEN place END AS rank
FROM scored s LEFT JOIN placed p ON s.doc_id = p.doc_id
"""
