"""Sources (S1–S8, U1–U3): explicit schemas, no inference, no driver loops over data."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True) -> DataFrame:
    """CSV scan with a declared schema (``sep=';'`` for the original layout)."""
    return spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE").csv(path)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per file (report, metadata, metrics)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_feature_names(spark: SparkSession, path: str) -> DataFrame:
    """``"12. sex_M"`` lines -> (position, name)."""
    t = spark.read.text(path)
    pat = r"^(\d+)\. (.*)$"
    return t.select(
        F.regexp_extract("value", pat, 1).try_cast("int").alias("position"),
        F.regexp_extract("value", pat, 2).alias("feature"),
    ).filter(F.col("position").isNotNull())


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if "_corrupt_record" in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType(), True)])


def read_batches(spark: SparkSession, directory: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """S4 + U1: every CSV batch in ``directory``; a file with any malformed
    record is skipped whole (the reference drops the file, not the row).

    Adds ``_file`` and ``_mtime`` from the file metadata.
    """
    s = _with_corrupt(schema)
    try:
        # A file is judged on whole rows: the CSV parser must parse every column,
        # or malformed values in columns a query does not read go unnoticed.
        raw = (
            spark.read.schema(s).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnPruning", False)
            .option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.csv")
            .option("ignoreCorruptFiles", True).csv(directory)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # anything but a missing directory is the caller's to know
            raise
        return spark.createDataFrame([], T.StructType(schema.fields + [
            T.StructField("_file", T.StringType()), T.StructField("_mtime", T.TimestampType()),
            T.StructField("_blk", T.LongType()), T.StructField("_mono", T.LongType())]))
    raw = raw.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_modification_time").alias("_mtime"),
                     F.col("_metadata.file_block_start").alias("_blk"),
                     F.monotonically_increasing_id().alias("_mono"))
    # bad-file list: bounded by the number of files (the file index already lives on the driver)
    first = F.col(f"`{schema.fieldNames()[0]}`").cast("string")
    bad = raw.filter(F.col("_corrupt_record").isNotNull() & (F.coalesce(first, F.lit("")) != F.lit("\u0000"))).select("_file").distinct()
    good = raw.join(F.broadcast(bad), "_file", "left_anti")
    return good.select(*[F.col(f"`{c}`") for c in schema.fieldNames()], "_file", "_mtime", "_blk", "_mono")


def recent_rows(batches: DataFrame, limit_rows: int) -> DataFrame:
    """S3: newest files first (mtime desc, path desc), whole files in file order,
    first ``limit_rows`` rows (``batches`` from :func:`read_batches`).

    Only per-(file, block) counts are ordered (one row per file split, the
    size of the file index); a row's position is its block's offset plus its
    read order inside the block, so no task holds more than one split.
    """
    per_blk = batches.groupBy("_file", "_mtime", "_blk").agg(F.count("*").alias("_n"))
    wf = Window.orderBy(F.desc("_mtime"), F.desc("_file"), F.asc("_blk")).rowsBetween(Window.unboundedPreceding, -1)
    offs = per_blk.select("_file", "_blk", F.coalesce(F.sum("_n").over(wf), F.lit(0)).alias("_off")).filter(
        F.col("_off") < limit_rows
    )
    chosen = batches.join(F.broadcast(offs), ["_file", "_blk"])  # one row per split
    wr = Window.partitionBy("_file", "_blk").orderBy("_mono")
    ranked = chosen.select("*", (F.col("_off") + F.row_number().over(wr) - 1).alias("_pos"))
    keep = [c for c in batches.columns if c not in ("_file", "_mtime", "_blk", "_mono")]
    return ranked.filter(F.col("_pos") < limit_rows).select(*[F.col(f"`{c}`") for c in keep], "_pos")


@dataclass(frozen=True)
class OpenedFile:
    """A file that was read: its rows per split, or no rows where it is malformed or unreadable."""

    path: str
    rows: dict[int, int]


def newest_first(spark: SparkSession, directory: str, glob: str = "*.csv") -> Iterator[str]:
    """O1: files of a directory by falling modification time and path, from the listing alone.

    Sorted on the cluster and fetched a partition at a time, as far as the caller asks."""
    try:
        listed = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(directory)
                  .select(F.col("_metadata.file_path").alias("path"), "modificationTime"))  # no content is read
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return iter(())
    return (r["path"] for r in listed.orderBy(F.desc("modificationTime"), F.desc("path")).toLocalIterator())


def _scan(spark: SparkSession, paths: list[str], schema: T.StructType, sep: str) -> DataFrame:
    raw = (spark.read.schema(_with_corrupt(schema)).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
           .option("columnPruning", False).option("columnNameOfCorruptRecord", "_corrupt_record")
           .option("recursiveFileLookup", True).csv(paths))
    return raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_blk"),
                      F.monotonically_increasing_id().alias("_mono"))


def _opened(spark: SparkSession, paths: list[str], schema: T.StructType, sep: str) -> list[OpenedFile]:
    """Rows per split of some files, in one job; one file each where a file cannot be read."""
    raw = _scan(spark, paths, schema, sep)
    # a hash over all columns is asked for: every value is parsed, so a malformed one shows
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in schema.fieldNames()])
    try:
        found = raw.groupBy("_file", "_blk").agg(F.count("*").alias("n"), F.max(F.when(F.col("_corrupt_record").isNotNull(), whole)).alias("bad")).collect()
    except PySparkException as error:
        if not (error.getCondition() or "").startswith("FAILED_READ_FILE"):
            raise
        if len(paths) == 1:
            return [OpenedFile(paths[0], {})]
        return [one for path in paths for one in _opened(spark, [path], schema, sep)]
    bad = {r["_file"] for r in found if r["bad"] is not None}
    return [OpenedFile(path, {r["_blk"]: r["n"] for r in found if r["_file"] == path and path not in bad}) for path in paths]


def open_newest(spark: SparkSession, directory: str, schema: T.StructType, limit_rows: int, sep: str = ",") -> list[OpenedFile]:
    """Files opened, newest first, until they hold ``limit_rows`` good rows.

    Files are opened in groups of 1, 2, 4, ...: few jobs, and at most about
    twice the files that are needed; older files are never touched."""
    newest, opened, group = newest_first(spark, directory), [], 1
    while sum(sum(f.rows.values()) for f in opened) < limit_rows:
        paths = list(islice(newest, group))
        if not paths:
            break
        opened += _opened(spark, paths, schema, sep)
        group *= 2
    return opened


def recent_files(spark: SparkSession, directory: str, schema: T.StructType, limit_rows: int, sep: str = ",") -> DataFrame:
    """S3 with an early stop: the first ``limit_rows`` rows of the newest files, whole files in
    file order, with their position ``_pos``; malformed and unreadable files are skipped whole."""
    offsets, at = [], 0
    for f in open_newest(spark, directory, schema, limit_rows, sep):
        for block in sorted(f.rows):
            if at < limit_rows:
                offsets.append((f.path, block, at))
            at += f.rows[block]
    if not offsets:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_pos", T.LongType())]))
    offs = spark.createDataFrame(offsets, "_file string, _blk long, _off long")
    rows = _scan(spark, list(dict.fromkeys(path for path, _, _ in offsets)), schema, sep)
    chosen = rows.join(F.broadcast(offs), ["_file", "_blk"])  # one row per split opened
    within = Window.partitionBy("_file", "_blk").orderBy("_mono")
    ranked = chosen.select("*", (F.col("_off") + F.row_number().over(within) - 1).alias("_pos"))
    return ranked.filter(F.col("_pos") < limit_rows).select(*[F.col(f"`{c}`") for c in schema.fieldNames()], "_pos")


def latest_rows(df: DataFrame, limit_rows: int, order_cols: list[str]) -> DataFrame:
    """S3 on a table / O7: newest ``limit_rows`` by a total order (TakeOrdered, top-k per task)."""
    return df.orderBy(*[F.desc(c) for c in order_cols]).limit(limit_rows)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; columns missing on one side become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def random_row(df: DataFrame, key_cols: list[str], seed: int = 42) -> DataFrame:
    """One deterministic pseudo-random row (md5(seed | key) order)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_cols]))
    return df.orderBy(h, *key_cols).limit(1)


def read_feature_matrix(spark: SparkSession, path: str, split: str, label: str = "label"):
    """(X, y) of one split; the split filter prunes partitions at the scan."""
    df = spark.read.parquet(path).filter(F.col("split") == split)
    return df.drop("split", label), df.select(label)
