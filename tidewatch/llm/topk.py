"""Exact top-k by inner product with a pivot-distance index.

Vectors get one more component that brings them to a common length, so the
largest inner products are the smallest distances.  Each vector is keyed by
its nearest pivot and its distance from it; the distances of a pivot are cut
into annuli at sample quantiles, and an annulus into chunks of bounded size.
A query first searches the annulus it falls into itself, which gives it a
k-th best score; then it visits, nearest first, only the annuli that the
triangle inequality does not rule out, in two rounds, the second with the
better bound of the first.  Bounds carry a rounding allowance, scores are exact
integers, so the result is exact; the pivots (from a bounded sample) only
decide how much is skipped.

Pivots and annulus edges are numbers fixed by parameters (64 pivots, 8 annuli
each); queries meet vectors in shuffles by (annulus, chunk, block of queries), so a
place with very many equal vectors, or one that very many queries visit, is many
groups of bounded size.  A group returns only scores that reach a query's bound.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; vectors of unequal length are compared as if filled up with
zeros; rows of one vec_id are no candidates of one another; a query that occurs
repeatedly with the same vector is answered once, and one vec_id with several
vectors once for each, with ranks of its own; where a score might not fit a long
(a squared length of 2**63 or more) the search raises ValueError.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches, read_table
from tidewatch.session import stage_table

K = 10
PIVOTS = 64
ANNULI = 8
SAMPLE = 8_192  # vectors that pivots and annulus edges are chosen from
CHUNK = 2_048  # vectors of an annulus that one task row holds
QUERY_BLOCK = 4_096  # queries that meet a chunk in one group
FIRST = 6  # annuli of the second round
SEED = 5
EXACT = 2.0**52


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v): components as floor(scale * x); rows that take no part are left out."""
    def bad(x):
        d = x.cast("double")
        return x.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))

    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.exists(vec_col, bad))
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")))


class Index:
    """Pivots, the common squared length and the annulus edges."""

    def __init__(self, pivots: np.ndarray, top: float, edges: np.ndarray):
        self.pivots, self.top, self.edges = pivots, top, edges

    def lifted(self, v: np.ndarray) -> np.ndarray:
        last = np.sqrt(np.maximum(0.0, self.top - (v * v).sum(axis=1)))
        return np.concatenate([v, last[:, None]], axis=1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(0.0, square))

    def annulus(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the annulus of each point, and the distance from its pivot."""
        d = self.distances(points)
        near = d.argmin(axis=1)
        own = d[np.arange(len(points)), near]
        ring = (own[:, None] >= self.edges[near]).sum(axis=1)
        return near * ANNULI + ring, own


def _filled(values: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Rows of the given sizes, filled up with zeros."""
    out = np.zeros((len(sizes), width))
    first = np.cumsum(sizes) - sizes
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(first, sizes)] = values
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    offsets = column.offsets.to_numpy()
    return _filled(column.values.to_numpy()[offsets[0]:offsets[-1]], np.diff(offsets), width)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products (float products are exact below 2**52)."""
    if queries.size and vectors.size and np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


def build(points: DataFrame) -> tuple[Index, int] | None:
    """Index parameters from a bounded sample and one aggregate."""
    n, width, top = points.agg(
        F.count("*"), F.max(F.size("v")),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()
    if not n:
        return None
    if top is not None and top >= 2.0**63:  # no inner product is larger than the largest squared length
        raise ValueError("inner products of these vectors do not fit a long")
    unit = F.xxhash64("id", "v", F.lit(SEED)).bitwiseAND(F.lit((1 << 53) - 1))
    sample = points.filter(unit <= int((1 << 53) * min(1.0, SAMPLE / n))).select("v").limit(4 * SAMPLE).toArrow()
    v = _matrix(sample["v"].combine_chunks(), width) if sample.num_rows else np.zeros((1, width))
    v = v[np.lexsort(v.T)] if width else v
    index = Index(np.zeros((1, width + 1)), float(top or 0.0), np.zeros((1, 0)))
    lifted = index.lifted(v)
    rng = np.random.default_rng(SEED)
    centres = lifted[rng.choice(len(lifted), size=min(PIVOTS, len(lifted)), replace=False)]
    for _ in range(8):  # a few rounds of k-means give pivots inside the clusters
        index.pivots = centres
        near = index.distances(lifted).argmin(axis=1)
        centres = np.stack([lifted[near == p].mean(axis=0) if (near == p).any() else centres[p] for p in range(len(centres))])
    index.pivots = centres
    d = index.distances(lifted)
    near = d.argmin(axis=1)
    steps = np.arange(1, ANNULI) / ANNULI
    index.edges = np.stack([np.quantile(d[near == p, p], steps) if (near == p).any() else np.zeros(len(steps))
                            for p in range(len(centres))])
    return index, width


def top_k(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (id, v) that satisfy ``is_query``."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    vectors = stage_table(vectors, "topk")
    built = build(vectors)
    if built is None:
        return empty
    index, width = built

    def place(batch: pa.RecordBatch) -> dict:
        v = _matrix(batch.column("v"), width)
        ring, own = index.annulus(index.lifted(v))
        return {"id": batch.column("id"), "v": batch.column("v"), "ring": ring, "own": own}

    placed = stage_table(map_batches(vectors, place, "id long, v array<long>, ring int, own double"), "topk-placed")
    # one row per annulus: how far it reaches, and in how many chunks it lies
    rings = {r["ring"]: (r["lo"], r["hi"], -(-r["n"] // CHUNK)) for r in
             placed.groupBy("ring").agg(F.min("own").alias("lo"), F.max("own").alias("hi"), F.count("*").alias("n")).collect()}
    names = np.array(sorted(rings), dtype=np.int64)
    lo, hi, parts = (np.array([rings[r][i] for r in names.tolist()]) for i in range(3))
    chunk_of = F.pmod(F.xxhash64("id", "v", F.lit(3)), F.get(F.array(*[F.lit(int(rings.get(r, (0, 0, 1))[2])) for r in
                                                                 range(int(names.max()) + 1)]), F.col("ring"))).cast("int")
    chunks = placed.select("ring", chunk_of.alias("chunk"), "id", "v")
    asking = placed.filter(is_query)
    blocks = -(-max(1, asking.count()) // QUERY_BLOCK)
    queries = (asking.select("id", "v", "ring").distinct().withColumn("q", F.xxhash64("id", "v"))
               .withColumn("block", F.pmod("q", F.lit(blocks)).cast("int")))

    def visits(batch_queries: DataFrame, first: int, last: int | None) -> DataFrame:
        """Rows (ring, chunk, id, v) of the annuli a query visits, nearest first; those
        that cannot hold a score above its bound are left out."""
        def run(batch: pa.RecordBatch) -> dict | None:
            v = _matrix(batch.column("v"), width)
            bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
            home = batch.column("ring").to_numpy()
            points = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
            d = index.distances(points)[:, names // ANNULI]
            gap = np.maximum(0.0, np.maximum(d - hi, lo - d))
            gap = np.maximum(0.0, gap * (1 - 1e-9) - 1e-6 * np.sqrt(1 + index.top))
            best = ((v * v).sum(axis=1)[:, None] + index.top - gap * gap) / 2  # no score in the annulus is larger
            order = np.argsort(gap, axis=1, kind="stable")
            place = np.empty_like(order)
            np.put_along_axis(place, order, np.arange(len(names))[None], axis=1)
            take = (place >= first) & (names[None] != home[:, None])
            if last is not None:
                take &= place < last
            limit = np.where(np.isnan(bound), -np.inf, bound)[:, None]
            take &= best * (1 + 1e-9) + 1 >= limit
            q, r = np.nonzero(take)
            if not len(q):
                return None
            times = parts[r]
            q, r = np.repeat(q, times), np.repeat(r, times)
            chunk = np.arange(len(q)) - np.repeat(np.cumsum(times) - times, times)
            pick = pa.array(q)
            return {"ring": names[r], "chunk": chunk, **{c: batch.column(c).take(pick) for c in ("block", "id", "q", "v", "bound")}}

        return map_batches(batch_queries, run, "ring int, chunk int, block int, id long, q long, v array<long>, bound long")

    def search(asked: DataFrame) -> DataFrame:
        """Each query's k best of every chunk it visits, as far as they reach its bound."""
        def matrix(v: pd.Series) -> np.ndarray:
            return _filled(np.concatenate([np.zeros(0), *v]), np.array([len(x) for x in v], dtype=np.int64), width)

        def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(left) and len(right):
                w, ids = matrix(right["w"]), right["vec_id"].to_numpy()
                for at in range(0, len(left), 256):
                    part = left.iloc[at:at + 256]
                    score = _scores(matrix(part["v"]), w)
                    known = part["bound"].notna().to_numpy()
                    least = part["bound"].fillna(0).to_numpy().astype(np.int64)
                    take = (score >= least[:, None]) | ~known[:, None]  # int64 on both sides: exact
                    take &= part["id"].to_numpy()[:, None] != ids[None]
                    for i in np.flatnonzero(take.any(axis=1)).tolist():
                        other = np.flatnonzero(take[i])
                        if len(other) > k:  # all that tie with the k-th stay for the exact cut
                            kth = np.partition(score[i, other], len(other) - k)[len(other) - k]
                            other = other[score[i, other] >= kth]
                        best = other[np.lexsort([ids[other], -score[i, other]])][:k]
                        out.append(pd.DataFrame({"query_id": part["id"].iat[i], "q": part["q"].iat[i], "vec_id": ids[best], "score": score[i, best]}))
            return pd.concat(out) if out else pd.DataFrame({"query_id": [], "q": [], "vec_id": [], "score": []}).astype("int64")

        # a chunk is repeated for the blocks of queries that visit it, no others
        visited = asked.select("ring", "chunk", "block").distinct().toDF("at_ring", "at_chunk", "by")
        met = chunks.toDF("at_ring", "at_chunk", "vec_id", "w").join(visited, ["at_ring", "at_chunk"])
        return (asked.groupBy("ring", "chunk", "block").cogroup(met.groupBy("at_ring", "at_chunk", "by"))
                .applyInPandas(run, "query_id long, q long, vec_id long, score long"))

    ranked = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        """The k best of each query; each task sends on k rows of a query at most."""
        return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)

    def bounded(found: DataFrame) -> DataFrame:
        kth = best(found).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "q", F.col("score").alias("bound"))
        return queries.join(kth, ["id", "q"], "left")

    home_chunks = F.sequence(F.lit(0), F.get(F.array(*[F.lit(int(rings.get(r, (0, 0, 1))[2]) - 1) for r in
                                                   range(int(names.max()) + 1)]), F.col("ring")))
    found = stage_table(search(queries.select("ring", F.explode(home_chunks).alias("chunk"), "block", "id", "q", "v",
                                              F.lit(None).cast("long").alias("bound"))), "topk-0")
    near = stage_table(search(visits(bounded(found), 0, FIRST)), "topk-1")
    found = found.unionByName(near)
    rest = stage_table(search(visits(bounded(found), FIRST, None)), "topk-2")
    return best(found.unionByName(rest)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector against all ``embeddings``."""
    return top_k(scaled(read_table(spark, sf_dir, "embeddings")), F.col("id") % 100 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
