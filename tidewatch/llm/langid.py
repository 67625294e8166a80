"""Hyperdimensional language profiles.

Every letter has a random vector of +1 and -1.  A trigram is bound from its
letters' vectors, the first permuted twice and the second once; a document is
the bundle (sum) of its trigrams; a language is the bundle of its training
documents, each at unit length.  Documents are compared with the languages by
cosine.

Texts are lower-cased; everything that is not a letter is a gap, and runs of
gaps count once.  Letters a to z have a vector each, all other letters share
37 vectors by code point.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when nothing was learned; ties go to the name that sorts
first; a score is the cosine, at least 0.  Repeated rows count and get a row
each; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import fold, map_batches, read_table, whole_text
from tidewatch.llm.packing import text_groups

DIMENSIONS = 512
SYMBOLS = 64  # gap, a to z, 37 classes of other letters
SEED = 20_231
CELLS = 4 << 20  # counts of (text, trigram) held at once


class Hyperspace:
    """Letter vectors and the vectors of whole texts."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        letters = rng.choice(np.array([-1, 1], dtype=np.int8), size=(SYMBOLS, dimensions))
        self.last = letters
        self.middle = np.roll(letters, 1, axis=1)
        self.first = np.roll(letters, 2, axis=1)
        self.symbol = np.zeros(0x110000, dtype=np.uint8)
        other = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
        codes = np.flatnonzero(other)
        self.symbol[codes] = 27 + codes % 37
        self.symbol[97:123] = np.arange(1, 27)

    def vectors(self, texts: list[str]) -> np.ndarray:
        """One row per text (all zero: no letter)."""
        lowered = [t.lower() for t in texts]
        sizes = np.array([len(t) + 2 for t in lowered])
        codes = self.symbol[np.frombuffer((" " + "  ".join(lowered) + " ").encode("utf-32-le"), dtype=np.uint32)]
        owner = np.repeat(np.arange(len(texts)), sizes)
        keep = codes != 0
        keep[1:] |= (codes[:-1] != 0) | (owner[1:] != owner[:-1])
        keep[0] = True
        codes, owner = codes[keep].astype(np.int64), owner[keep]
        gram = codes[:-2] * SYMBOLS**2 + codes[1:-1] * SYMBOLS + codes[2:]
        inside = owner[:-2] == owner[2:]
        gram, owner = gram[inside], owner[:-2][inside]
        used = np.flatnonzero(np.bincount(gram, minlength=SYMBOLS**3))
        place = np.zeros(SYMBOLS**3, dtype=np.int64)
        place[used] = np.arange(len(used))
        out = np.zeros((len(texts), self.last.shape[1]), dtype=np.float32)
        if not len(used):
            return out
        bound = self.first[used // SYMBOLS**2] * self.middle[used // SYMBOLS % SYMBOLS] * self.last[used % SYMBOLS]
        bound = bound.astype(np.float32)
        step = max(1, CELLS // len(used))
        for lo in range(0, len(texts), step):  # owners rise, so a block of texts is one slice
            hi = min(lo + step, len(texts))
            a, b = np.searchsorted(owner, [lo, hi])
            counts = np.bincount((owner[a:b] - lo) * len(used) + place[gram[a:b]], minlength=(hi - lo) * len(used))
            out[lo:hi] = counts.reshape(hi - lo, -1).astype(np.float32) @ bound
        return out

    def has_letter(self, text: str) -> bool:
        return any(c.isalpha() for c in text)


_SPACES: dict[tuple[int, int], Hyperspace] = {}


def hyperspace(dimensions: int, seed: int) -> Hyperspace:
    """One per Python worker."""
    key = dimensions, seed
    if key not in _SPACES:
        _SPACES[key] = Hyperspace(*key)
    return _SPACES[key]


def _unit(v: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, size, out=np.zeros_like(v), where=size > 0)


def train(docs: DataFrame, usable: Column, dimensions: int = DIMENSIONS, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes, from all usable rows: bundles are sums, so tasks hold one per language."""
    rows = docs.filter(usable & F.col("lang").isNotNull())

    def run(batch: pa.RecordBatch) -> dict:
        space = hyperspace(dimensions, seed)
        texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), dtype=object)
        total: dict[str, np.ndarray] = {}
        for lo, hi in text_groups(texts):
            v = _unit(space.vectors(texts[lo:hi]))
            for lang in sorted(set(langs[lo:hi])):
                total[lang] = total.get(lang, 0) + v[langs[lo:hi] == lang].sum(axis=0, dtype=np.float64)
        return {"lang": list(total), "bundle": list(total.values())}

    parts = map_batches(rows.select(F.col("lang").cast("string").alias("lang"), whole_text().alias("text")), run,
                        "lang string, bundle array<double>")
    # one number per language and dimension comes back
    sums = (parts.select("lang", F.posexplode("bundle").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
            .collect())
    langs = sorted({r["lang"] for r in sums})
    bundle = np.zeros((len(langs), dimensions))
    for r in sums:
        bundle[langs.index(r["lang"]), r["d"]] = r["x"]
    return langs, _unit(bundle)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray, dimensions: int = DIMENSIONS,
            seed: int = SEED) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    profile = prototypes.astype(np.float32).T

    def run(batch: pa.RecordBatch) -> dict:
        space = hyperspace(dimensions, seed)
        texts = batch.column("text").to_pylist()
        names, scores = [], []
        for lo, hi in text_groups(texts):
            if not langs:
                names += ["und"] * (hi - lo)
                scores += [0.0] * (hi - lo)
                continue
            cosine = _unit(space.vectors(texts[lo:hi])) @ profile
            best = cosine.argmax(axis=1)
            for t, b, c in zip(texts[lo:hi], best, cosine.max(axis=1)):
                known = space.has_letter(t)
                names.append(langs[b] if known else "und")
                scores.append(float(min(1.0, max(0.0, c))) if known else 0.0)
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": names, "score": scores}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == 1).alias("held_out"),
                                   whole_text().alias("text")), run,
                       "doc_id long, held_out boolean, lang_pred string, score double")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    langs, prototypes = train(docs, fold() != 1)
    return predict(docs, langs, prototypes)
