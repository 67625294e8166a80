"""Threshold-scaled sketches of documents.

A sketch keeps every hash of a five-word shingle that lies below a fixed
fraction of the hash space, whatever the document's length, so sketches of
very unequal documents can be intersected and merged.  So that short texts are
not left without any hash, a sketch with fewer than ``floor`` hashes is filled
up with the document's next smallest ones; two sketches are always compared
below the smaller of their two thresholds, where both are complete.

Sketches are sorted arrays of longs and all functions are Column expressions.

Defined results: null and empty texts have the empty sketch (likeness 1 to one
another, 0 to any other); a text of fewer than five words has one shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import range_index, read_table, whole_text

WORDS = 5
FRACTION = 1 / 8
FLOOR = 32
LEAST = -(1 << 63)
ROWS_PER_BUCKET = 500
MAX_BUCKETS = 65_536


def threshold(fraction: float = FRACTION) -> int:
    """Signed hashes below this are the retained fraction."""
    return LEAST + int(fraction * 2.0**64)


def with_sketch(df: DataFrame, text: str, name: str, words: int = WORDS, fraction: float = FRACTION,
                floor: int = FLOOR) -> DataFrame:
    """Add the sketch of column ``text`` as array column ``name``.

    Built in steps so that no array is computed twice."""
    w, h, k = f"{name}_words", f"{name}_hashes", f"{name}_kept"
    tokens = F.array_remove(F.split(F.lower(F.col(text)), r"\s+"), "")
    shingles = F.when(F.size(w) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(F.col(w), i, words)))).otherwise(F.array().cast("array<bigint>"))
    kept = F.array_distinct(F.filter(h, lambda x: x < threshold(fraction)))
    full = F.when(F.size(k) >= floor, F.array_sort(k)).otherwise(F.slice(F.array_sort(F.array_distinct(h)), 1, floor))
    return (df.withColumn(w, tokens).withColumn(h, shingles).drop(w)
            .withColumn(k, kept).withColumn(name, full).drop(h, k))


def limit_of(sketch: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """Below this hash the sketch is complete."""
    return (F.when(F.size(sketch) < floor, F.lit((1 << 63) - 1))
            .otherwise(F.greatest(F.lit(threshold(fraction)), F.element_at(sketch, -1) + 1)))


def merge(a: Column, b: Column, fraction: float = FRACTION, floor: int = FLOOR) -> Column:
    """Sketch of the union of two documents' shingles."""
    both = F.array_sort(F.array_union(a, b))
    kept = F.filter(both, lambda x: x < threshold(fraction))
    return F.when(F.size(kept) >= floor, kept).otherwise(F.slice(both, 1, floor))


def with_likeness(df: DataFrame, a: str, b: str, likeness: str, containment: str) -> DataFrame:
    """Estimated Jaccard of the two shingle sets and the share of a's shingles found in b."""
    x, y, c = f"{likeness}_x", f"{likeness}_y", f"{likeness}_common"
    both = F.least(limit_of(F.col(a)), limit_of(F.col(b)))
    out = (df.withColumn(c, both)
           .withColumn(x, F.filter(F.col(a), lambda v: v < F.col(c)))
           .withColumn(y, F.filter(F.col(b), lambda v: v < F.col(c)))
           .withColumn(c, F.size(F.array_intersect(x, y))))
    union = F.size(x) + F.size(y) - F.col(c)
    return (out.withColumn(likeness, F.when(union == 0, F.lit(1.0)).otherwise(F.col(c) / union))
            .withColumn(containment, F.when(F.size(x) == 0, F.lit(1.0)).otherwise(F.col(c) / F.size(x)))
            .drop(x, y, c))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(df: DataFrame, id_col: str, carry: dict[str, str]) -> DataFrame:
    """Add, by descending id, columns of the next row (after the last row: of the first).

    Ids are cut into buckets whose upper bounds are ids that occur; the rows at
    a bound are copied into the bucket above, where they follow its last row.
    So every bucket finds its successors within itself, texts are shuffled
    once, and no global window is needed.  A null id sorts last; rows of one
    id lie in one bucket, in the order of their text's hash.
    """
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST))
    ids = df.select(order.alias("k"))
    n, top = ids.agg(F.count("*"), F.max("k")).first()
    buckets = max(1, min(MAX_BUCKETS, n // ROWS_PER_BUCKET))
    steps = [i / buckets for i in range(1, buckets)]
    cuts = ids.agg(F.percentile_approx("k", steps, 20 * buckets).alias("q")).first()["q"] if steps and n else []
    bounds = sorted(set(cuts or []) | ({top} if top is not None else set()))
    # bucket i holds ids above bounds[i - 1] and up to bounds[i]
    bucket = range_index(F.col("_key"), [b + 1 for b in bounds[:-1]])
    at_bound = F.array(*[F.lit(b) for b in bounds or [LEAST]])
    keyed = (df.withColumn("_key", order).withColumn("_bucket", bucket)
             .withColumn("_copies", F.when(F.get(at_bound, F.col("_bucket")) == F.col("_key"),
                                           F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
             .withColumn("_copy", F.explode("_copies")).drop("_copies")
             .withColumn("_bucket", F.pmod(F.col("_bucket") + F.col("_copy"), F.lit(max(1, len(bounds))))))
    window = Window.partitionBy("_bucket").orderBy("_copy", F.desc("_key"), "_tie")
    out = keyed.withColumn("_tie", F.xxhash64("text"))
    for source, name in carry.items():
        out = out.withColumn(name, F.lead(source).over(window))
    return out.filter("_copy = 0").drop("_key", "_bucket", "_copy", "_tie")


def fingerprints(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Sketches of each text, of its edited text, and their likeness."""
    base = docs.select(id_col, whole_text().alias("text")).withColumn("n_chars", F.length("text").cast("long"))
    base = with_sketch(base, "text", "sketch")
    pairs = with_next(base, id_col, {"text": "next_text", "sketch": "next_sketch"})
    pairs = (pairs.withColumn("moved", F.expr("cast(n_chars div 3 as int)"))
             .withColumn("edited", F.concat(F.expr("substring(text, 1, cast(n_chars as int) - moved)"),
                                            F.expr("substring(next_text, 1, moved)")))
             .drop("text", "next_text", "moved"))
    pairs = with_sketch(pairs, "edited", "edited_sketch")
    pairs = with_likeness(pairs, "sketch", "edited_sketch", "near_edited", "held_by_edited")
    return with_likeness(pairs, "sketch", "next_sketch", "near_next", "held_by_next")


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    return fingerprints(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next", "held_by_edited", "held_by_next")
