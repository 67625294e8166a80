"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token is a linked list of parts.  Every adjacent pair that has a merge
rank waits in the bucket of that rank; a three-level bitmap over ranks tells by
find-first-set which bucket comes next.  Entries are not removed when a
neighbour changes: an entry whose place no longer forms a pair of that rank is
skipped when it comes up.  Work is proportional to the number of pairs ever
formed, so a pre-token of a whole text costs no more per byte than a word.

Defined results: null and empty texts have no ids; repeated rows are encoded
once each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches, read_table, whole_text
from tidewatch.llm.packing import ChunkEncoder, text_groups

CACHE_CHUNKS = 400_000
GROUP = 1 << 23  # characters of texts whose new pre-tokens share a queue


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class RankQueue:
    """Positions by merge rank; the next rank is found in three bitmap levels."""

    __slots__ = ("top", "middle", "low", "buckets")

    def __init__(self):
        self.top = 0
        self.middle: dict[int, int] = {}
        self.low: dict[int, int] = {}
        self.buckets: dict[int, list] = {}

    def push(self, rank: int, at: list) -> None:
        """Open the bucket of a rank that has none."""
        self.buckets[rank] = at
        word = rank >> 6
        group = word >> 6
        self.low[word] = self.low.get(word, 0) | 1 << (rank & 63)
        self.middle[group] = self.middle.get(group, 0) | 1 << (word & 63)
        self.top |= 1 << group

    def first(self) -> int:
        """The least rank that has entries, or -1."""
        if not self.top:
            return -1
        group = (self.top & -self.top).bit_length() - 1
        bits = self.middle[group]
        word = group << 6 | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << 6 | (bits & -bits).bit_length() - 1

    def take(self, rank: int) -> list:
        """All entries of a rank; clears its bits."""
        word = rank >> 6
        group = word >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[group] &= ~(1 << (word & 63))
            if not self.middle[group]:
                self.top &= ~(1 << group)
        return self.buckets.pop(rank)


class Merger:
    """Merges by rank.  Pre-tokens that are given together share one queue:
    merges in different pre-tokens do not touch, so the order between them is
    free and a bucket serves them all."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.one = np.full(256, -1, dtype=np.int64)  # ids of single bytes
        for token, rank in ranks.items():
            if len(token) == 1:
                self.one[token[0]] = rank
        # rank of a pair by the ids of its halves, for every way to halve a token
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.two = np.full(1 << 16, -1, dtype=np.int64)  # the same for two bytes, as a table
        for token, rank in ranks.items():
            if len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs by the ids of their halves; -1: none."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], -1).astype(np.int32) if len(self.keys) else np.full(len(key), -1, dtype=np.int32)

    def ids(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token (none of them empty).

        A bucket's entries are merged at once, which gives the order of one by
        one as long as no merge opens a smaller rank than its own; pre-tokens in
        which one does are merged again by themselves, one by one."""
        raw = b"".join(pieces)
        n = len(raw)
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        pair, part, swallowed = self._begin(raw, pieces, starts, ends)
        pair, part = pair.astype(np.int32), part.astype(np.int32)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        edge = np.zeros(n + 1, dtype=bool)
        edge[starts] = edge[n] = True
        before[starts] = -1
        queue = RankQueue()
        again = set()

        def push(places: np.ndarray, ranks: np.ndarray) -> None:
            some = ranks >= 0
            places, ranks = places[some], ranks[some]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            lows = [0, *cut.tolist()]
            for rank, lo, hi in zip(ranks[lows].tolist(), lows, [*lows[1:], len(places)]):
                if rank in queue.buckets:
                    queue.buckets[rank].append(places[lo:hi])
                else:
                    queue.push(rank, [places[lo:hi]])

        push(np.arange(n, dtype=np.int32), pair)
        rank = queue.first()
        while rank >= 0:
            at = np.concatenate(queue.take(rank))
            at = np.unique(at[pair[at] == rank])  # others are stale: their pair has changed since
            if len(at):
                right = after[at]
                chain = np.flatnonzero(at[1:] == right[:-1])  # pairs that share a part: leftmost first
                if len(chain):
                    keep = np.ones(len(at), dtype=bool)
                    for k in chain.tolist():
                        if keep[k]:
                            keep[k + 1] = False
                    at, right = at[keep], right[keep]
                end = after[right]
                inner = ~edge[end]
                follows, own = end[inner], at[inner]
                passing = self._rank(np.full(len(own), rank), part[follows])  # before a neighbour merges too
                after[at] = end
                part[at] = rank
                pair[right] = -2
                pair[at] = -1
                before[follows] = own
                fresh = self._rank(part[own], part[follows])
                pair[own] = fresh
                left = before[at]
                left = left[left >= 0]
                other = self._rank(part[left], np.full(len(left), rank))
                pair[left] = other
                for places, ranks in ((own, passing), (own, fresh), (left, other)):
                    low = (ranks >= 0) & (ranks < rank)
                    if low.any():
                        again.update((np.searchsorted(starts, places[low], side="right") - 1).tolist())
                push(np.concatenate([own, left]), np.concatenate([fresh, other]))
            rank = queue.first()
        alive = (pair != -2) & ~swallowed
        out = part[alive].tolist()
        stops = np.cumsum(alive)[ends - 1].tolist()
        got = [out[lo:hi] for lo, hi in zip([0, *stops], stops)]
        for k in again:
            got[k] = self.one_by_one([pieces[k]])[0]
        return got

    def _begin(self, raw: bytes, pieces: list[bytes], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank of the pair, id of the part that begin at each byte, bytes inside whole tokens)."""
        n = len(raw)
        data = np.frombuffer(raw, dtype=np.uint8).astype(np.int64)
        found = np.full(n, -1, dtype=np.int64)
        found[:-1] = self.two[data[:-1] << 8 | data[1:]]
        found[ends - 1] = -1
        first = self.one[data]
        swallowed = np.zeros(n, dtype=bool)
        for start, end, piece in zip(starts.tolist(), ends.tolist(), pieces):
            whole = self.ranks.get(piece)  # a whole pre-token that is a token is that token
            if whole is not None:
                found[start:end] = -1
                first[start] = whole
                swallowed[start + 1:end] = True
        return found, first, swallowed

    def one_by_one(self, pieces: list[bytes]) -> list[list[int]]:
        """The same, entry by entry, for rank tables of any kind."""
        get = self.pairs.get
        raw = b"".join(pieces)
        n = len(raw)
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        found, first, swallowed = self._begin(raw, pieces, starts, ends)
        queue = RankQueue()
        places = np.flatnonzero(found >= 0)
        places = places[np.argsort(found[places], kind="stable")]
        kinds, at = np.unique(found[places], return_index=True)
        cuts = [*at.tolist(), len(places)]
        places = places.tolist()
        for rank, lo, hi in zip(kinds.tolist(), cuts, cuts[1:]):
            queue.push(rank, places[lo:hi])
        part = first.tolist()  # id of the part that begins here
        pair = found.tolist()  # rank of the pair that begins here; -1: none; -2: the part is swallowed
        after = list(range(1, n + 1))  # where the part that begins here ends
        before = list(range(-1, n - 1))  # where the part to the left begins
        edge = bytearray(n + 1)  # a pre-token begins here
        edge[n] = 1
        for s in starts.tolist():
            edge[s] = 1
            before[s] = -1
        buckets = queue.buckets
        rank = queue.first()
        while rank >= 0:
            entries = sorted(queue.take(rank))
            lowest = rank
            for done, i in enumerate(entries):
                if pair[i] != rank:
                    continue  # stale: the pair has changed since
                j = after[i]  # the right part, now swallowed
                end = after[j]
                after[i] = end
                part[i] = rank
                pair[j] = -2
                got = None if edge[end] else get(rank << 32 | part[end])
                if got is None:
                    pair[i] = -1
                else:
                    pair[i] = got
                    if got in buckets:
                        buckets[got].append(i)
                    else:
                        queue.push(got, [i])
                        if got < lowest:
                            lowest = got
                if not edge[end]:
                    before[end] = i
                h = before[i]
                if h >= 0:
                    got = get(part[h] << 32 | rank)
                    if got is None:
                        pair[h] = -1
                    elif got != pair[h]:
                        pair[h] = got
                        if got in buckets:
                            buckets[got].append(h)
                        else:
                            queue.push(got, [h])
                            if got < lowest:
                                lowest = got
                if lowest < rank:  # a merge has opened a smaller rank: it comes first
                    rest = entries[done + 1:]
                    if rest:
                        if rank in buckets:
                            buckets[rank].extend(rest)
                        else:
                            queue.push(rank, rest)
                    break
            rank = queue.first()
        alive = (np.array(pair) != -2) & ~swallowed
        out = np.array(part)[alive].tolist()
        stops = np.cumsum(alive)[ends - 1].tolist()
        return [out[lo:hi] for lo, hi in zip([0, *stops], stops)]


class BytePairCodec:
    """Whole texts to ids and back, with a bounded cache of chunks.

    Texts are cut at spaces before something other than white space, where the
    pattern always starts a new match (see ``packing.ChunkEncoder``).  The
    cache holds a chunk's ids as text, once they have been decoded again."""

    def __init__(self, ranks_path: str, pattern: str, cache_chunks: int = CACHE_CHUNKS):
        import regex

        self.merger = Merger(read_ranks(ranks_path))
        self.tokens = {i: b for b, i in self.merger.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.cache_chunks = cache_chunks

    def _matches(self, text: str) -> list[bytes]:
        word = text[1:] if text[:1] == " " else text
        if word.isascii() and word.isalpha():  # a run of letters is one match
            return [text.encode()]
        return [m.encode() for m in self.find(text)]

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        matches = [self._matches(t) for t in texts]
        distinct = list({m for own in matches for m in own})
        ids = dict(zip(distinct, self._merged(distinct)))
        return [ids[own[0]] if len(own) == 1 else [i for m in own for i in ids[m]] for own in matches]

    def _merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Pre-tokens in shares of bounded size (a long one may be a share alone)."""
        out, share, size = [], [], 0
        for p in pieces:
            share.append(p)
            size += len(p)
            if size >= 1 << 21:
                out += self.merger.ids(share)
                share, size = [], 0
        return out + (self.merger.ids(share) if share else [])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def digest_many(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: number of ids, hash of the ids as text, hash of the decoded bytes."""
        cut = [ChunkEncoder.chunks(t) for t in texts]
        for own in cut:
            if not own[0]:
                del own[0]
        known = self.young
        missing = set().union(*cut).difference(known)
        for c in missing.intersection(self.old):
            known[c] = self.old[c]
        todo = list(missing.difference(known))
        odd = {}  # chunks whose ids decode to other bytes: none under a complete byte vocabulary
        for c, ids in zip(todo, self.encode_many(todo)):
            known[c] = " ".join(map(str, ids))
            decoded = self.decode(ids)
            if decoded != c.encode():
                odd[c] = decoded
        get, out = known.__getitem__, []
        for t, own in zip(texts, cut):
            ids = " ".join(map(get, own))
            decoded = t.encode() if not odd else b"".join(odd.get(c, c.encode()) for c in own)
            out.append((ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded).hexdigest()))
        for c in odd:  # never cached, so always decoded anew
            del known[c]
        if len(known) > self.cache_chunks:
            self.old, self.young = known, {}
        return out


_CODECS: dict[tuple[str, str], BytePairCodec] = {}


def codec(ranks_path: str, pattern: str) -> BytePairCodec:
    """One codec per Python worker."""
    key = ranks_path, pattern
    if key not in _CODECS:
        _CODECS[key] = BytePairCodec(*key)
    return _CODECS[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): the ids of every text and the bytes they decode to."""
    def run(batch: pa.RecordBatch) -> dict:
        own = codec(ranks_path, pattern)
        texts = batch.column("text").to_pylist()
        ids = [i for lo, hi in text_groups(texts, GROUP) for i in own.encode_many(texts[lo:hi])]
        return {id_col: batch.column(id_col), "ids": ids, "decoded": [own.decode(i) for i in ids]}

    return map_batches(docs.select(F.col(id_col).cast("long").alias(id_col), whole_text().alias("text")), run,
                       f"{id_col} long, ids array<int>, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text."""
    def run(batch: pa.RecordBatch) -> dict:
        own = codec(ranks_path, pattern)
        texts = batch.column("text").to_pylist()
        rows = [r for lo, hi in text_groups(texts, GROUP) for r in own.digest_many(texts[lo:hi])]
        n, ids, decoded = zip(*rows)
        return {id_col: batch.column(id_col), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}

    return map_batches(docs.select(F.col(id_col).cast("long").alias(id_col), whole_text().alias("text")), run,
                       f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all ``documents`` under the public byte-level ranks, and their decoding."""
    import public_tokenizers

    return digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                   public_tokenizers.PATTERN)
