"""Subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character trigrams to five-grams (with word ends) and
of itself; each is a row of one embedding table, found by a hash.  A document
is the average of all its rows, and a linear softmax over the average gives
the class.  Table and softmax are trained jointly in numpy (momentum) on a bounded
sample of labelled rows, so an unseen misspelling is scored by the pieces it
shares with words seen.

Since the softmax is linear in the average, a trained word is two numbers:
the sum of its rows' class weights, and its number of rows.

Defined results: a text without words (null, empty) has the score of the
softmax's bias; without labelled rows of both classes every score is 0.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewatch.llm.common import fold, kept, map_arrow, map_batches, read_table, whole_text

WORD = re.compile(r"\w+")
BUCKETS = 1 << 17
DIMENSIONS = 4
SAMPLE_DOCS = 3_000  # bound of the labelled rows that are trained on, a third of them toxic where there are enough
EPOCHS = 12
BATCH = 64
STEPS = 700  # at least so many batches, however small the sample
RATE = 0.1
MOMENTUM = 0.9
SCALING = 0.25
LEAST_DOCS = 2  # rows that fewer sampled documents hold are not trained, whatever the sample; decay holds rare ones
GAIN = 10.0  # the average of many rows is small; fixed scale before the softmax
DECAY = 1e-5
SEED = 7
CUT = 0.7
CACHE_WORDS = 300_000


def subwords(word: str) -> list[int]:
    """Rows of one word."""
    w = f"<{word}>"
    pieces = {w[i:i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1)}
    pieces.add(w)
    return [zlib.crc32(p.encode()) % BUCKETS for p in sorted(pieces)]


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a whole text and their share of it."""
    rows, weight = [], []
    for w, n in Counter(WORD.findall(text.lower())).items():
        own = subwords(w)
        rows += own
        weight += [math.sqrt(n)] * len(own)
    if not rows:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    ids, back = np.unique(np.asarray(rows), return_inverse=True)
    share = np.bincount(back, weights=weight)
    return ids.astype(np.int32), (share / share.sum()).astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
        seed: int = SEED) -> tuple[np.ndarray, float] | None:
    """Class weight (label 1 against 0) of every row of the table, and the bias."""
    labels = np.asarray(labels, dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    # the bags end to end, in a few large arrays that the driver gives back when done
    ids = np.concatenate([b[0] for b in bags]).astype(np.int32, copy=False)
    share = np.concatenate([b[1] for b in bags]).astype(np.float32, copy=False)
    size = np.array([len(b[0]) for b in bags], dtype=np.int64)
    used, held_by = np.unique(ids, return_counts=True)
    used = used[held_by >= LEAST_DOCS]
    if not len(used):
        return None
    shared = np.isin(ids, used)
    size = np.add.reduceat(np.append(shared, False), np.cumsum(size) - size, dtype=np.int64) * (size > 0)
    ids, share = np.searchsorted(used, ids[shared]).astype(np.int32), share[shared]
    start = np.append(0, np.cumsum(size))
    table = rng.normal(0, 0.01, size=(len(used), DIMENSIONS)).astype(np.float32)
    soft = rng.normal(0, 0.3, size=(DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    params = [table, soft, bias]
    speed = [np.zeros_like(p) for p in params]
    # rows are scaled down as their average share grows: rare ones learn nearly as fast as common ones
    scale = ((np.bincount(ids, weights=share, minlength=len(used)) / len(bags)) ** -SCALING).astype(np.float32)
    share *= scale[ids]
    per_epoch = -(-len(bags) // BATCH)
    epochs = max(epochs, -(-STEPS // per_epoch))
    step, total = 0, epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            rows = np.concatenate([ids[start[i]:start[i + 1]] for i in pick])
            held = np.concatenate([share[start[i]:start[i + 1]] for i in pick]) * GAIN
            doc = np.repeat(np.arange(len(pick)), size[pick])
            gathered = table[rows] * held[:, None]
            mean = np.stack([np.bincount(doc, weights=gathered[:, d], minlength=len(pick)) for d in range(DIMENSIONS)], axis=1)
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            p /= len(pick)
            back = (p @ soft.T)[doc] * held[:, None]
            grads = [np.stack([np.bincount(rows, weights=back[:, d], minlength=len(used)) for d in range(DIMENSIONS)], axis=1)
                     + DECAY * table, mean.T @ p, p.sum(axis=0)]
            step += 1
            rate = RATE * (1 - (step - 1) / total)
            for value, grad, pace in zip(params, grads, speed):
                pace *= MOMENTUM
                pace -= rate * grad
                value += pace
    out = np.zeros(BUCKETS, dtype=np.float32)
    out[used] = GAIN * scale * (table @ (soft[:, 1] - soft[:, 0]))
    return out, float(bias[1] - bias[0])


class Scorer:
    """Scores of whole texts under a trained table, with a bounded cache of words."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[str, complex] = {}  # sum of a word's weights and number of its rows, as one small object

    def _word(self, word: str) -> complex:
        rows = subwords(word)
        found = complex(float(self.weights[rows].sum()), len(rows))
        if len(self.known) >= CACHE_WORDS:
            self.known = {}
        if len(word) <= 64:
            self.known[word] = found
        return found

    def score(self, text: str) -> float:
        get = self.known.get
        total = 0j
        for w, times in Counter(WORD.findall(text.lower())).items():
            found = get(w) or self._word(w)
            total += found if times == 1 else found * math.sqrt(times)
        logit = self.bias + (total.real / total.imag if total.imag else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -60, 60))))


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample_docs: int = SAMPLE_DOCS,
          seed: int = SEED) -> tuple[np.ndarray, float] | None:
    """Fit on about ``sample_docs`` usable labelled rows, chosen by a hash of the id."""
    rows = labels.select("doc_id", "toxic").filter(usable & F.col("toxic").isin(0, 1))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    wanted = {1: sample_docs // 3, 0: sample_docs - sample_docs // 3}
    unit = F.xxhash64("doc_id", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1))
    share = {k: min(1.0, max(wanted[k], sample_docs - n[1 - k]) / n[k]) for k in n}
    picked = rows.filter(unit <= F.when(F.col("toxic") == 1, F.lit(int((1 << 53) * share[1]))).otherwise(F.lit(int((1 << 53) * share[0]))))

    def run(batch: pa.RecordBatch) -> dict:
        bags = [bag(t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "rows": [b[0] for b in bags],
                "share": [b[1] for b in bags]}

    # the sample is bounded, so its ids may be broadcast and its bags collected
    sample = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(picked), "doc_id")
    got = map_batches(sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("toxic").cast("int").alias("toxic")),
                      run, "doc_id long, toxic int, rows array<int>, share array<float>").toArrow()
    if not got.num_rows:
        return None
    order = np.lexsort([got["toxic"].to_numpy(), got["doc_id"].to_numpy()])
    bags = [(got["rows"][int(i)].values.to_numpy(), got["share"][int(i)].values.to_numpy()) for i in order]
    return fit(bags, got["toxic"].to_numpy()[order], seed=seed)


def _scorer(spark: SparkSession, model: tuple[np.ndarray, float]):
    """Key of this model's scorer (a table of BUCKETS numbers), and what gives the worker's one in a task."""
    shared = spark.sparkContext.broadcast((model[0].astype(np.float32), model[1]))
    key = uuid.uuid4().hex
    return key, lambda: kept(key, lambda: Scorer(*shared.value))


def with_score(docs: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    """Columns of ``docs`` and ``score`` (0 to 1) as the last one."""
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    key, scorer = _scorer(docs.sparkSession, model)

    def run(batches):
        own = scorer()
        for batch in batches:
            scores = pa.array([own.score(t or "") for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "score"])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField("score", DoubleType())]), keeps=key)


def without_toxic(docs: DataFrame, model: tuple[np.ndarray, float] | None, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``."""
    if model is None:
        return docs
    key, scorer = _scorer(docs.sparkSession, model)

    def run(batches):
        own = scorer()
        for batch in batches:
            yield batch.filter(pa.array([own.score(t or "") < cut for t in batch.column("text").to_pylist()], pa.bool_()))

    return map_arrow(docs, run, docs.schema, keeps=key)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = train(docs, labels, fold() != 1)
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold() == 1).alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
