"""Concatenate and cut: pack token streams into fixed windows.

Two passes.  The first tokenises every document and writes its ids together
with their place in the partition's own token stream.  Partition totals are
then summed into global offsets (one row per partition).  The second pass
cuts the stream at multiples of the window; a document that crosses an edge
leaves boundary records on both sides.

Defined results: a null text is the empty one (a document of the single end
id); an empty table gives no rows; repeated rows are packed once each; other
columns are ignored.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, map_arrow, read_table, whole_text
from tidewatch.session import stage_table

WINDOW = 1024
END_ID = 0
CACHE_CHUNKS = 400_000


class ChunkEncoder:
    """Ids of whole texts by a ``tokenizers`` file, chunk by chunk.

    A byte-level pre-tokeniser of this family always starts a new pre-token at
    a space that is followed by something other than white space, so a text
    may be cut there and its chunks encoded apart.  Chunks repeat; their ids
    (little-endian unsigned 32-bit) are kept in a bounded cache.
    """

    def __init__(self, tokenizer_path: str, cache_chunks: int = CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # one character of a byte-level token stands for one byte
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.cache_chunks = cache_chunks

    @staticmethod
    def chunks(text: str) -> list[str]:
        parts = text.split(" ")
        if "" not in parts and not any(p[0].isspace() for p in parts[1:]):
            return parts[:1] + [" " + p for p in parts[1:]]
        out = [parts[0]]
        for p in parts[1:]:
            if p and not p[0].isspace():
                out.append(" " + p)
            else:
                out[-1] += " " + p
        return out

    def _joined(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk from one call: token lengths in bytes find the chunks' ends."""
        joined = self.tokenizer.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0]
        ids = np.asarray(joined.ids, dtype="<u4")
        ends = np.cumsum([len(c.encode()) for c in chunks])
        at = np.cumsum(self.n_bytes[ids])
        cut = (np.searchsorted(at, ends) + 1) * 4
        if at[-1] != ends[-1] or not np.array_equal(at[cut // 4 - 1], ends):
            raise ValueError("the tokenizer's tokens do not spell out its input")
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cut[:-1].tolist()], cut.tolist())]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        cut = [self.chunks(t) for t in texts]
        known = self.young
        missing = set()
        for c in cut:
            missing.update(c)
        missing.difference_update(known)
        if self.old:
            for c in missing.intersection(self.old):
                known[c] = self.old[c]
            missing.difference_update(known)
        # chunks that open with the cut's space can be encoded as one text again
        apart = [c for c in missing if c[:1] != " " or c[1:2].isspace() or len(c) < 2]
        missing.difference_update(apart)
        todo = list(missing)
        for k in range(0, len(todo), 2000):
            known.update(zip(todo[k:k + 2000], self._joined(todo[k:k + 2000])))
        for c, e in zip(apart, self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)):
            known[c] = np.asarray(e.ids, dtype="<u4").tobytes()
        get = known.__getitem__
        out = [b"".join(map(get, c)) for c in cut]
        if len(known) > self.cache_chunks:
            self.old, self.young = known, {}
        return out


class RankEncoder:
    """The same ids from the vocabulary's rank file, several times as fast.

    Texts with a special token or with letters beyond the Latin blocks, where
    the two libraries' character tables might differ, go to ``tokenizers``."""

    LATIN = re.compile("[^\\x00-\u024f]")

    def __init__(self, tokenizer_path: str, ranks_path: str, pattern: str):
        import tiktoken

        self.other = ChunkEncoder(tokenizer_path)
        self.special = [str(t) for t in self.other.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for t in texts:
            if self.LATIN.search(t) or any(x in t for x in self.special):
                out += self.other.encode_many([t])
            else:
                out.append(array("I", self.encoding.encode_ordinary(t)).tobytes())
        return out


def encoder_of(tokenizer_path: str, ranks: tuple[str, str] | None) -> ChunkEncoder | RankEncoder:
    """One encoder (and cache) per Python worker, kept from task to task."""
    return kept((tokenizer_path, ranks), lambda: RankEncoder(tokenizer_path, *ranks) if ranks else ChunkEncoder(tokenizer_path))


def text_groups(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Slices of about ``most`` characters, one text at least."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def token_streams(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", end_id: int = END_ID,
                  ranks: tuple[str, str] | None = None) -> DataFrame:
    """First pass: (part, local_start, doc_id, n_tokens, ids) with ids as bytes."""
    schema = f"part int, local_start long, {id_col} long, n_tokens long, ids binary"
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, at = TaskContext.get().partitionId(), 0
        encoder = encoder_of(tokenizer_path, ranks)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in text_groups(texts):
                ids = [x + end for x in encoder.encode_many(texts[lo:hi])]
                n = np.fromiter((len(x) // 4 for x in ids), dtype=np.int64, count=len(ids))
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), part, dtype=np.int32)), pa.array(starts),
                     batch.column(id_col).slice(lo, hi - lo).cast(pa.int64()), pa.array(n), pa.array(ids, pa.binary())],
                    names=["part", "local_start", id_col, "n_tokens", "ids"])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias(id_col), whole_text().alias("text")), run, schema,
                     keeps=(tokenizer_path, ranks))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", window: int = WINDOW,
         end_id: int = END_ID, ranks: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece, with the piece's ids as bytes and whether it touches a cut.

    ``ranks``: rank file and pattern of the same vocabulary (see RankEncoder)."""
    streams = stage_table(token_streams(docs, tokenizer_path, id_col, end_id, ranks), "packing")
    totals = streams.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # one row per partition of the first pass: a bounded prefix sum and broadcast
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shift"))
    placed = (streams.join(F.broadcast(offsets), "part")
              .withColumn("at", F.col("shift") + F.col("local_start")))
    first = F.expr(f"at div {window}")
    last = F.expr(f"(at + n_tokens - 1) div {window}")
    pieces = placed.select(id_col, "at", "n_tokens", "ids", F.explode(F.sequence(first, last)).alias("sequence_id"))
    lo = F.greatest(F.col("at"), F.col("sequence_id") * window)
    hi = F.least(F.col("at") + F.col("n_tokens"), (F.col("sequence_id") + 1) * window)
    cut = pieces.select(id_col, "n_tokens", "ids", "sequence_id", (lo - F.col("at")).alias("start"), (hi - lo).alias("length"),
                        (lo - F.col("sequence_id") * window).alias("offset"),
                        ((lo > F.col("at")) | (hi < F.col("at") + F.col("n_tokens"))).alias("boundary"))
    return cut.select(
        id_col, "start", "length",
        F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))").alias("piece"),
        F.col("n_tokens").alias("doc_tokens"), "sequence_id", "offset", "boundary")


def public_vocabulary() -> tuple:
    """Arguments of ``pack`` for the public byte-level vocabulary."""
    import public_tokenizers as public

    return (public.path("byte_bpe_50k.json"), "doc_id", WINDOW, END_ID,
            (public.path("byte_bpe_50k.tiktoken"), public.PATTERN))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all ``documents`` in sequences of 1024 tokens."""
    pieces = pack(read_table(spark, sf_dir, "documents"), *public_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("piece").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "boundary")
