"""Exact top-k inner products over norm-sorted, SVD-rotated vectors.

Vectors become integers, are range-partitioned and sorted by descending
length, and written once.  Queries come in blocks of bounded size.  For each
block the longest vectors of all (a bounded head) give every query a first
k-th best score; then each task walks its files, each from the longest vector
down: a query skips a chunk when |q| |v| is below its k-th best score for the
chunk's longest vector, whatever files the task reads in whatever order,
and of the rest only pairs whose partial product over the leading rotated
dimensions plus the product of the residual lengths (Cauchy-Schwarz) reaches
it are scored.  Scores are integer products, exact; bounds carry a margin for
rounding, so no pair is lost.

Defined cases: NULL vectors and vectors with a NULL or non-finite component
take no part, nor do NULL ids; shorter vectors count as padded with zeros;
rows repeated under one id are each a candidate, and as a query the smallest
of them counts; a query's own id is never its candidate; ties go to the
smaller id; scores beyond 64 bits are clipped to them; empty tables give no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chanmart.llm.common import prepare, staged

SCALE = 256
HEAD = 4096
BLOCK = 4096
CHUNK = 512
#: Largest sum that float64 products hold exactly.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id, v (floor of scale * x, as doubles) and norm of the vectors that take part."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    fine = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda c: _floor(c * F.lit(float(scale))))
    rows = vectors.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))


def _one_vector_each(rows: DataFrame) -> DataFrame:
    """The smallest vector of each id, shorter ones compared and returned as padded with zeros."""
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    padded = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("v")))
    return rows.groupBy("id").agg(F.min(padded).alias("v"))


def _floor(c: Column) -> Column:
    """Floor as a double, whatever its size (beyond 2^53 doubles are whole)."""
    return F.when(F.abs(c) < EXACT, F.floor(c).cast("double")).otherwise(c)


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    if n and (lengths == dim).all():
        return flat[offsets[0] : offsets[-1]].reshape(n, dim).astype(np.float64)
    out = np.zeros((n, dim))
    for i in range(n):
        out[i, : lengths[i]] = flat[offsets[i] : offsets[i + 1]]
    return out


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of the vector matrix, strongest first, from its dim x dim Gram matrix."""

    def gram(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            m = _matrix(batch.column(0), dim)
            total += m.T @ m
        i, j = np.indices((dim, dim))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    sums = rows.select("v").mapInArrow(gram, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    matrix = np.zeros((dim, dim))
    for r in sums.collect():  # dim * dim rows
        matrix[r["i"], r["j"]] = r["s"]
    if not np.isfinite(matrix).all():
        return np.eye(dim)
    return np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1].copy()


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise exact inner products of whole-numbered rows, as int64 (clipped)."""
    if not len(a):
        return np.zeros(0, np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a, b)]
    return np.array([max(-LONG - 1, min(LONG, s)) for s in whole], np.int64)


def _best(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best rows of each query: higher score, then smaller id."""
    order = np.lexsort((ids, -scores.astype(np.float64) if len(scores) and np.abs(scores).max() < EXACT else -np.argsort(np.argsort(scores, kind="stable"), kind="stable"), q))
    if not len(order):
        return order
    first = np.concatenate([[True], q[order][1:] != q[order][:-1]])
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[place < k]


class Block:
    """A block of queries with their rotated forms and their best rows so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rotate: np.ndarray, k: int, floors: np.ndarray):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.rotated = vectors @ rotate
        self.norms = np.linalg.norm(vectors, axis=1)
        self.lead = max(1, rotate.shape[1] // 4)
        self.rest = np.linalg.norm(self.rotated[:, self.lead :], axis=1)
        self.floor = floors.astype(np.float64)  # no result scores below its query's floor
        self.q = np.zeros(0, np.int64)
        self.found = np.zeros(0, np.int64)
        self.scores = np.zeros(0, np.int64)

    def visit(self, ids: np.ndarray, vectors: np.ndarray, rotate: np.ndarray) -> bool:
        """Score a chunk of candidates, of any lengths; False when no query can gain from it."""
        longest = np.linalg.norm(vectors, axis=1).max()
        slack = 1e-9 * self.norms * longest + 1e-6
        active = np.flatnonzero(self.norms * longest + slack >= self.floor)
        if not len(active):
            return False
        rotated = vectors @ rotate
        rest = np.linalg.norm(rotated[:, self.lead :], axis=1)
        bound = self.rotated[active, : self.lead] @ rotated[:, : self.lead].T + self.rest[active, None] * rest[None, :]
        q, c = np.nonzero(bound + slack[active, None] >= self.floor[active, None])
        q = active[q]
        other = self.ids[q] != ids[c]
        q, c = q[other], c[other]
        scores = np.concatenate([_products(self.vectors[q[i : i + 65536]], vectors[c[i : i + 65536]]) for i in range(0, max(1, len(q)), 65536)])
        reach = scores >= self.floor[q]
        self._merge(q[reach], ids[c[reach]], scores[reach])
        return True

    def _merge(self, q, ids, scores) -> None:
        q, ids, scores = np.concatenate([self.q, q]), np.concatenate([self.found, ids]), np.concatenate([self.scores, scores])
        keep = _best(q, ids, scores, self.k)
        self.q, self.found, self.scores = q[keep], ids[keep], scores[keep]
        full = np.flatnonzero(np.bincount(self.q, minlength=len(self.ids)) >= self.k)
        last = np.searchsorted(self.q, full, side="right") - 1
        # one below a clipped float is still a safe floor
        self.floor[full] = np.maximum(self.floor[full], np.nextafter(self.scores[last].astype(np.float64), -np.inf) if len(last) and np.abs(self.scores[last]).max() >= EXACT else self.scores[last])


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: int = SCALE,
    head_rows: int = HEAD,
    block_rows: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: every query's k best of all other vectors."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = integer_vectors(vectors, id_col, vec_col, scale)
    # a hash behind the length splits vectors of equal length
    by_length = rows.repartitionByRange(F.desc("norm"), F.xxhash64("id", F.monotonically_increasing_id())).sortWithinPartitions(F.desc("norm"))
    table = staged(by_length, "vectors-by-length")
    asked = staged(_one_vector_each(integer_vectors(queries, id_col, vec_col, scale).select("id", "v")), "query-vectors")
    n_queries = asked.count()
    dim = max([1, *(r[0] for r in (f.agg(F.max(F.size("v"))).first() for f in (table, asked)) if r[0])])
    rotate = rotation(table, dim)
    head = table.orderBy(F.desc("norm")).limit(head_rows).toArrow()  # bounded
    head_ids, head_vectors = head.column("id").to_numpy(), _matrix(head.column("v"), dim)
    schema = "query_id long, vec_id long, score long"
    blocks = max(1, -(-n_queries // block_rows))
    results = []
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow()
        ids, wanted = part.column("id").to_numpy(), _matrix(part.column("v"), dim)
        order = np.argsort(ids)
        ids, wanted = ids[order], wanted[order]
        seed = Block(ids, wanted, rotate, k, np.full(len(ids), -np.inf))
        for i in range(0, len(head_ids) if len(ids) else 0, CHUNK):
            if not seed.visit(head_ids[i : i + CHUNK], head_vectors[i : i + CHUNK], rotate):
                break
        sent = spark.sparkContext.broadcast((ids, wanted, rotate, seed.floor))

        def scan(batches, sent=sent):
            ids, wanted, rotate, floors = sent.value
            block = Block(ids, wanted, rotate, k, floors)
            for batch in batches if len(ids) else ():
                vec_ids, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1), rotate.shape[0])
                # a task may read several sorted files in any order, so every chunk is asked
                for i in range(0, len(vec_ids), CHUNK):
                    block.visit(vec_ids[i : i + CHUNK], matrix[i : i + CHUNK], rotate)
            yield pa.RecordBatch.from_arrays([pa.array(block.ids[block.q]), pa.array(block.found), pa.array(block.scores)], names=["query_id", "vec_id", "score"])

        results.append(table.select("id", "v").mapInArrow(scan, schema))
    found = results[0]
    for r in results[1:]:
        found = found.unionByName(r)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_exact_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return exact_top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(r AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""
