"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text of a document; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 3; remainder 1 is held out from training."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


BATCH_ROWS = 2_500
BATCH_BYTES = 2 << 20


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Cut Arrow batches at ``most`` bytes for this session, unless it sets a bound itself.

    Only the size of the pieces in which rows go to Python changes; Spark's own
    bound (64 MB) is held several times over in the JVM and the worker of every task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(most))


_KEPT: dict = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def kept(key, build: Callable):
    """In a task: what ``build`` gives, held by the worker for later tasks under the same key."""
    if key not in _KEPT:
        drop_kept()
        _KEPT[key] = build()
    return _KEPT[key]


def drop_kept(but=None) -> None:
    """Let go of what the worker holds for another step than this one."""
    for key in [k for k in _KEPT if k != but]:
        del _KEPT[key]


def give_back() -> None:
    """Return unused memory to the system: a worker lives on after its task, and
    what it holds counts against its executor in every later step."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keeps=None) -> DataFrame:
    """``mapInArrow`` in workers that hold nothing but ``keeps`` (a key of ``kept``) from one task to the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(keeps)
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str) -> DataFrame:
    """``mapInArrow`` over batches of bounded length: ``fn`` returns columns by name (or None).

    The result columns are cast to the Arrow types of ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):  # bounds what a task holds beside the batch
                cols = fn(whole.slice(at, BATCH_ROWS))
                if cols is not None:
                    yield pa.RecordBatch.from_arrays([_column(cols[f.name], f.type) for f in target], schema=target)

    return map_arrow(df, run, schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def range_index(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``: a binary search
    written as a fold over its log2 steps, so it stays one JVM expression."""
    if not bounds:
        return F.lit(0)
    arr = F.array(*[F.lit(b) for b in bounds])
    n = len(bounds)
    steps = [1 << k for k in reversed(range(n.bit_length()))]

    def step(pos: Column, width: Column) -> Column:
        nxt = pos + width
        return F.when((nxt <= n) & (F.get(arr, nxt - 1) <= value), nxt).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def shared_keys(rows: DataFrame, key: str, member: str) -> DataFrame:
    """Distinct (key, member) rows of the keys that several members have.

    One shuffle of two longs per row; a task reads its rows in key order and
    keeps one of them at a time, whatever the number of members of a key."""
    import numpy as np

    names = [key, member]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, m, running = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), False
        for batch in batches:
            k = np.concatenate([k, batch.column(key).to_numpy()])
            m = np.concatenate([m, batch.column(member).to_numpy()])
            if not len(k):
                continue
            keep = np.ones(len(k), dtype=bool)
            keep[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
            k, m = k[keep], m[keep]
            same = k[1:] == k[:-1]
            many = np.zeros(len(k), dtype=bool)
            many[1:] |= same
            many[:-1] |= same
            many[0] |= running
            # the last row waits for what follows; if ``many``, it belongs to a group already
            yield pa.RecordBatch.from_arrays([pa.array(k[:-1][many[:-1]]), pa.array(m[:-1][many[:-1]])], names=names)
            running = bool(many[-1])
            k, m = k[-1:], m[-1:]
        if running:
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(m)], names=names)

    return map_arrow(rows.select(*names).repartition(key).sortWithinPartitions(*names), run, f"{key} long, {member} long")


BITMAP_BITS = 1 << 24


def id_bitmap(ids: DataFrame, id_col: str) -> Callable:
    """A test for use in tasks: may this id be among ``ids``?  (Never a wrong no.)

    The bitmap has a fixed size (2 MB, whatever the number of ids), so it may
    be collected and sent along; callers join exactly afterwards."""
    import numpy as np

    bit = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(BITMAP_BITS))
    rows = (ids.select((bit + 1).alias("b"))  # Spark's bitmap functions count from one
            .groupBy(F.bitmap_bucket_number("b").alias("n"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect())
    raw = bytearray(BITMAP_BITS // 8)
    for r in rows:
        at = (r["n"] - 1) * 4096
        raw[at:at + len(r["bits"])] = r["bits"]
    shared = ids.sparkSession.sparkContext.broadcast(bytes(raw))

    def inside(values: np.ndarray) -> np.ndarray:
        b = xxhash64_long(values) & np.uint64(BITMAP_BITS - 1)
        table = np.frombuffer(shared.value, dtype=np.uint8)
        return (table[(b >> np.uint64(3)).astype(np.int64)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1

    return inside


def split_by_bitmap(rows: DataFrame, id_col: str, inside: Callable) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in the bitmap, rows whose id is not); null ids are not.

    Two scans, but only the first part has to be shuffled to be joined."""
    def part(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, BATCH_ROWS):
                    batch = whole.slice(at, BATCH_ROWS)
                    ids = batch.column(id_col).cast(pa.int64())
                    found = inside(ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
                    yield batch.filter(pa.array(found == wanted))

        return map_arrow(rows, run, rows.schema)

    return part(True), part(False)


def without_ids(rows: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` without those whose id is in ``gone``."""
    maybe, kept = split_by_bitmap(rows, id_col, id_bitmap(gone, id_col))
    return maybe.join(gone.select(id_col).distinct(), id_col, "left_anti").select(*rows.columns).unionByName(kept)


def xxhash64_long(values):
    """Spark's ``xxhash64`` of long values, as unsigned numbers."""
    import numpy as np

    p1, p2, p3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    p4, p5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)

    def turn(x, r):
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    v = np.asarray(values).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (turn(v * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


def connected_components(edges: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (a, b): columns (node, component).

    Alternates large-star and small-star steps; a node's neighbours meet only
    in aggregates (minimum) and in a join on the node, never as one array, so
    a hub with a third of all edges stays spread by map-side combining.  Each
    step is written to the shared folder, so a lost executor re-reads it.
    """
    cur = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter(F.col("a") != F.col("b")).distinct(), "cc")
    before = None
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large-star: every larger neighbour points to the least one around
        large = (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a != b").distinct())
        # small-star: a node and its smaller neighbours point to the least one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).filter("a != b").distinct())
        cur = stage(small, "cc")
        sign = tuple(cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if sign == before:
            break
        before = sign
    return cur.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
