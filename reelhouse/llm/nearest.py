"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Method (RaBitQ): a vector's offset from its block's centre is rotated at random, and one bit per
dimension keeps the signs. With two scalars per vector, the length of the offset and the agreement
of the offset with its code, the bits give an unbiased estimate of the inner product with any
query and a bound on its error. A query scans all codes of all blocks. Per block it takes the
exact products of the best estimates, and then of every vector whose estimate plus bound reaches
the worst of the nearest found so far. `CONFIDENCE` is the bound's width in standard deviations.

The index holds every valid vector; blocks have about `BLOCK` vectors, dealt by a hash of the
id. Queries are dealt to batches of about `QUERIES`, and every batch meets every block once: the
work is the stated query set against all rows, in blocks, and both sides of each meeting are
bounded. Of equal vectors the index keeps the `k` + 1 smallest ids, which is exact, since ties
go to smaller ids: a third of all rows with one vector add nothing.

Cases: vectors that are null, empty, zero, or hold a null or non-finite component take no part,
and neither do rows with a null id. Repeated rows count once; different vectors of one id are
candidates of their own, and as queries share one list. Vectors meet only vectors of
their own dimension. Fewer candidates than `k` are all returned, and a query without candidates
gets no row. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.blobs import changes
from reelhouse.llm.rows import chosen
from reelhouse.session import scratch_dir

K = 20
BLOCK = 8192
QUERIES = 4096
CONFIDENCE = 2.5
#: What single precision may take from a product, as a share of the lengths' product.
SLACK = np.float32(1e-4)
#: Queries that are estimated at a time, so that a matrix of estimates stays small.
AT_ONCE = 128

INDEX_DDL = (
    "block long, dim int, ids binary, vectors binary, codes binary, sizes binary, "
    "agreements binary, centre binary"
)
FOUND_DDL = "query_id long, vec_id long, score double"


@functools.lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same for everyone."""
    made, signs = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return made * np.sign(np.diag(signs))


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (vec_id, embedding) rows that take part."""
    limit = float("inf")
    whole = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (x < limit) & (x > -limit)
    )
    return (
        chosen(vectors, vec_id=id_col, embedding=vector_col)
        .withColumn("vec_id", F.col("vec_id").cast("long"))
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(whole & F.exists("embedding", lambda x: x != 0))
        .dropDuplicates(["vec_id", "embedding"])
    )


def _by_dimension(table: pa.Table, id_col: str):
    """(dimension, ids, vectors) for each dimension in a table."""
    ids = np.array(table[id_col].to_pylist(), np.int64)
    vectors = table["embedding"].combine_chunks()
    dims = np.array(pc.list_value_length(vectors).to_pylist(), np.int64)
    for dim in np.unique(dims).tolist():
        which = np.flatnonzero(dims == dim)
        flat = vectors.take(pa.array(which)).flatten().to_numpy(zero_copy_only=False)
        yield dim, ids[which], flat.astype(np.float64).reshape(len(which), dim)


def _build(table: pa.Table) -> pa.Table:
    """The index rows of one block."""
    block, rows = table["block"][0].as_py(), []
    for dim, ids, x in _by_dimension(table, "vec_id"):
        centre = x.mean(axis=0)
        turned = (x - centre) @ rotation(dim).T
        sizes = np.linalg.norm(turned, axis=1)
        agreement = np.abs(turned).sum(axis=1) / np.where(sizes > 0, sizes, 1) / math.sqrt(dim)
        agreement[sizes == 0] = 1
        rows.append(
            (
                block,
                dim,
                ids.tobytes(),
                x.tobytes(),
                np.packbits(turned >= 0, axis=1).tobytes(),
                sizes.tobytes(),
                agreement.tobytes(),
                centre.tobytes(),
            )
        )
    names = [n.split()[0] for n in INDEX_DDL.split(", ")]
    made = pa.table(dict(zip(names, zip(*rows, strict=True), strict=True)))
    return made.set_column(1, "dim", made["dim"].cast(pa.int32()))


class BlockIndex:
    """One index row, ready for queries."""

    def __init__(self, row: dict):
        self.dim = dim = row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        n = len(self.ids)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, dim)
        self.single = self.vectors.astype(np.float32)
        bits = np.frombuffer(row["codes"], np.uint8).reshape(n, -1)
        signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
        self.signs = np.ascontiguousarray(signs.T) / np.float32(math.sqrt(dim))
        sizes = np.frombuffer(row["sizes"], np.float64)
        agreement = np.frombuffer(row["agreements"], np.float64)
        self.centre = np.frombuffer(row["centre"], np.float64)
        self.scale = (sizes / agreement).astype(np.float32)
        spread = np.sqrt(np.maximum(1 / agreement**2 - 1, 0)) / math.sqrt(max(dim - 1, 1))
        self.bound = (sizes * spread).astype(np.float32)
        self.longest = np.float32(np.linalg.norm(self.vectors, axis=1).max())

    def exact(self, queries: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Inner products of pairs, summed in the order of the components."""
        total = np.zeros(len(q))
        for d in range(self.dim):
            total += queries[q, d] * self.vectors[c, d]
        return total

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, confidence: float):
        """(query id, vector id, score) arrays: the k nearest found in this block per query."""
        for i in range(0, len(queries), AT_ONCE):
            yield self._search(query_ids[i : i + AT_ONCE], queries[i : i + AT_ONCE], k, confidence)

    def _search(self, query_ids, queries, k, confidence):
        m, n = len(queries), len(self.ids)
        turned = (queries @ rotation(self.dim).T).astype(np.float32)
        estimate = (turned @ self.signs) * self.scale
        estimate += (queries @ self.centre).astype(np.float32)[:, None]
        first = min(n, 2 * k + 1)
        best = np.argpartition(estimate, n - first, axis=1)[:, n - first :]
        q = np.repeat(np.arange(m), first)
        c = best.ravel()
        score = self._approximate(queries, q, c)
        score[self.ids[c] == query_ids[q]] = -np.inf
        worst = np.sort(score.reshape(m, first), axis=1)[:, max(0, first - k)]
        if n <= first:
            worst = np.full(m, -np.inf)
        lengths = np.linalg.norm(queries, axis=1).astype(np.float32)
        worst = worst - SLACK * lengths * self.longest
        # written so that what overflows single precision is looked at
        maybe = ~(estimate + np.float32(confidence) * lengths[:, None] * self.bound < worst[:, None])
        np.put_along_axis(maybe, best, True, axis=1)
        q, c = np.nonzero(maybe)
        other = self.ids[c] != query_ids[q]
        q, c = q[other], c[other]
        near = ~(self._approximate(queries, q, c) < worst[q] - SLACK * lengths[q] * self.longest)
        q, c = q[near], c[near]
        score = self.exact(queries, q, c)
        order = np.lexsort((self.ids[c], -score, q))
        q, c, score = q[order], c[order], score[order]
        place = np.arange(len(q))
        rank = place - np.maximum.accumulate(np.where(changes(q), place, 0)) if len(q) else place
        top = rank < k
        return query_ids[q[top]], self.ids[c[top]], score[top]

    def _approximate(self, queries, q, c) -> np.ndarray:
        """Inner products of pairs in single precision, within `SLACK` of the lengths' product."""
        out, queries = np.empty(len(q), np.float32), queries.astype(np.float32)
        for i in range(0, len(q), 65_536):
            part = slice(i, i + 65_536)
            out[part] = np.einsum("ij,ij->i", queries[q[part]], self.single[c[part]])
        return out


def _meet(k: int, confidence: float):
    """One batch of queries in one block of the index."""

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(index) and len(queries):
            blocks = {row["dim"]: BlockIndex(row) for row in index.to_pylist()}
            for dim, ids, x in _by_dimension(queries, "query_id"):
                if dim in blocks:
                    found += blocks[dim].search(ids, x, k, confidence)
        query, vec, score = map(np.concatenate, zip(*found, strict=True))
        return pa.table({"query_id": query, "vec_id": vec, "score": score})

    return run


def build_index(vectors: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """The index rows over valid vectors (`valid`), `k` + 1 ids for each distinct vector."""
    same = Window.partitionBy("embedding").orderBy("vec_id")
    kept = vectors.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1).drop("n")
    blocks = max(1, -(-vectors.count() // block))
    dealt = kept.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(_build, INDEX_DDL)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    block: int = BLOCK,
    batch: int = QUERIES,
    confidence: float = CONFIDENCE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the nearest found of each query, best first.

    `is_query`: a condition on the column vec_id.
    """
    spark = vectors.sparkSession
    taking_part = valid(vectors, id_col, vector_col)
    folder = scratch_dir(spark)
    build_index(taking_part, k, block).write.parquet(f"{folder}/index")
    index = spark.read.schema(INDEX_DDL).parquet(f"{folder}/index")
    queries = taking_part.filter(is_query).withColumnRenamed("vec_id", "query_id")
    batches = max(1, -(-queries.count() // batch))
    blocks = max(1, -(-taking_part.count() // block))
    index = index.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    queries = queries.withColumn("batch", F.pmod(F.xxhash64("query_id"), F.lit(batches)).cast("int"))
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = (
        index.groupBy("block", "batch")
        .cogroup(queries.groupBy("block", "batch"))
        .applyInArrow(_meet(k, confidence), FOUND_DDL)
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: Brute force in SQL, over `embeddings`.
SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.embedding) = len(c.embedding)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank,
         vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
