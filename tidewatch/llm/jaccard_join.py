"""N-gram Jaccard join with PartEnum signatures.

Sets of word shingles are compared within bands of size.  Two sets of one band
whose similarity reaches the threshold differ in at most k elements; so when
the feature domain is cut into n1 parts of n2 pieces each, they agree on some
subset of n2 - k2 pieces of some part, and share the signature of that subset.
A set also signs for the next band where it can link across the edge.

Copies are one class first (equal sets), so only different sets meet.  Classes
that share a signature are linked as stars around the smallest document; a
second round takes other centres.  What is still in different components after
that is settled exactly: small signature groups pair by pair, documents of large
ones where they also share one of their rarest elements.  A subset of pieces
that holds but common elements (a line that many documents have) is shared by a
part of the whole table, so its pairs grow with the square of the input.  But
linked sets agree on at least one of the first n - ceil(t n) + 1 elements in any
order that is the same for all, and in an order by how common an element is
those are rare.  Groups of such an element are settled the same way: small ones
pair by pair, clusters of large ones block against block inside tasks.

How common an element is comes from a sample of the documents that are to be
settled, in a table of fixed size; it bears on the work only: whatever the
order, no link is lost.

Candidates first pass an odd sketch (1024 bits or more by size, each the parity
of the elements that hash there): two sketches differ in at most as many bits as the sets in
elements, so a pair that differs in more bits than a link allows is no link.
The rest is verified on the sets.  Sets are gathered for those documents only;
a bitmap of fixed size over their ids (false positives only) lets the scan
leave out the others.

Defined results: a text without words has the empty set and links with
nothing; fewer words than the shingle width are one shingle; rows of one
doc_id are each kept; rows without doc_id link with nothing and have no
component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import (connected_components, give_back, id_bitmap, map_arrow, map_batches, read_table, shared_keys,
                                  whole_text, xxhash64_long)
from tidewatch.llm.packing import text_groups
from tidewatch.llm.shingles import mix, shingle_sets
from tidewatch.session import stage_table

WIDTH = 4
NUMERATOR, DENOMINATOR = 85, 100  # linked from this Jaccard similarity on
STAR_ROUNDS = 2
SMALL = 16  # members of a signature whose pairs are formed by a join
BLOCK = 1_024  # m documents of larger groups meet in blocks of about sqrt(m * BLOCK): each is copied sqrt(m / BLOCK) times
LARGEST = 1 << 17  # sketches of a block at most
PIECE = 2_048  # sketches of a block that are compared at once
SAMPLED = 16  # one class of so many tells how common elements are
CELLS = 1 << 23  # of the table of that, a byte each
LEVELS = 8  # of its values: an element of 2, 8, 32, ... sampled sets
PAIRS = 1 << 17  # pairs that a task holds before it returns them, about
SKETCH_WORDS = 16  # of 64 bits, at least; about two bits for three elements


class Bands:
    """Sizes in bands that grow by half, and the signature scheme of each."""

    def __init__(self, numerator: int = NUMERATOR, denominator: int = DENOMINATOR):
        self.num, self.den = numerator, denominator
        self.low = [1]
        # linked sets differ in size by at most den / num, so their sketches' lengths by at most this factor
        self.reach = 1 << (-(-denominator // numerator) - 1).bit_length()

    def of(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, -(-3 * self.low[-1] // 2)))
        return int(np.searchsorted(self.low, size, side="right")) - 1

    def scheme(self, band: int) -> tuple[int, int, int, int]:
        """(n1, n2, pieces left out of a subset, empty pieces that may be passed over)."""
        top = self.low[band + 1] - 1
        k = 2 * top * (self.den - self.num) // (self.den + self.num)  # largest symmetric difference of a link
        if k == 0:
            return 1, 1, 0, 0
        if k <= 3:
            return 1, k + 2, k, 0
        spare = 2 + k // 32
        return k // 2 + 1 + spare, 3 if k < 24 else 2, 1, spare


def signatures(values: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature) of every subset of pieces.

    With k2 = 1 difference per part at most floor(k / 2) parts are bad, so
    ``spare`` + 1 parts hold a subset both sets agree on.  A set with at most
    ``spare`` empty subsets has one among them that is not empty, so its empty
    subsets need no signature; others sign their empty subsets too.
    """
    first = np.cumsum(sizes) - sizes
    scattered = mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    member: dict[int, list[int]] = {}
    for i, n in enumerate(sizes.tolist()):
        if n:
            for b in range(bands.of(n), bands.of(n * bands.den // bands.num) + 1):
                member.setdefault(b, []).append(i)
    who, sig = [], []
    for b, own in member.items():
        n1, n2, drop, spare = bands.scheme(b)
        own = np.array(own)
        n = sizes[own]
        at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        row = np.repeat(np.arange(len(own)), n)
        pieces = n1 * n2
        piece = (mix(values[at] + np.uint64(b)) % np.uint64(pieces)).astype(np.int64)
        total = np.zeros(len(own) * pieces, dtype=np.uint64)
        np.add.at(total, row * pieces + piece, scattered[at])
        count = np.bincount(row * pieces + piece, minlength=len(total)).reshape(len(own), n1, n2)
        total = total.reshape(len(own), n1, n2)
        if n1 == 1 and drop:  # two of n2 pieces
            i, j = np.triu_indices(n2, 1)
            subset, held = total[:, 0, i] + total[:, 0, j] * np.uint64(3), count[:, 0, i] + count[:, 0, j]
        elif n2 == 3:  # two of three
            subset = total.sum(axis=2, keepdims=True) - total
            held = (count.sum(axis=2, keepdims=True) - count).reshape(len(own), -1)
        else:  # single pieces, or the whole set
            subset, held = total, count.reshape(len(own), -1)
        subset = subset.reshape(len(own), -1)
        place = mix(np.arange(subset.shape[1], dtype=np.uint64) + np.uint64((b + 1) << 32))
        value = mix(subset ^ place)
        keep = held > 0
        if spare or n1 == 1:
            keep |= ((~keep).sum(axis=1) > spare)[:, None]
        r, c = np.nonzero(keep)
        who.append(own[r])
        sig.append(value[r, c])
    if not who:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(who), np.concatenate(sig)


def rarest(values: np.ndarray, sizes: np.ndarray, level: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, element) of the first elements of each set by (level, element).

    Of a set of n, a linked one has t n elements at least, so leaves out fewer
    than are taken here; of those both have, the first one in the order is
    among the taken ones of both."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(owner * (LEVELS + 1) + level, kind="stable")  # the elements of a set come in order
    place = np.arange(len(values)) - (np.cumsum(sizes) - sizes)[owner]
    most = sizes - -(-bands.num * sizes // bands.den) + 1
    taken = place < most[owner]
    return owner[taken], values[order[taken]]


def _classes(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit number per set (0 for the empty one); equal sets have equal numbers."""
    at = np.cumsum(sizes) - sizes
    out = np.zeros(len(sizes), dtype=np.uint64)
    some = sizes > 0
    if some.any():
        out[some] = np.add.reduceat(mix(values + np.uint64(0x1234567)), at[some])
        out[some] = mix(out[some] + sizes[some].astype(np.uint64)) | np.uint64(1)
    return out


def sketch_words(sizes: np.ndarray) -> np.ndarray:
    """Length of the sketch of a set, in words of 64 bits."""
    return np.maximum(SKETCH_WORDS, 1 << np.ceil(np.log2(np.maximum(1, sizes) / 96)).astype(np.int64).clip(0))


def sketches(values: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Odd sketch of each set; its length grows with the set (a power of two of words)."""
    place = mix(values ^ np.uint64(0x0DD0DD0DD0DD0DD))
    first = np.cumsum(sizes) - sizes
    words = sketch_words(sizes)
    out: list[bytes] = [b""] * len(sizes)
    for w in np.unique(words).tolist():
        own = np.flatnonzero(words == w)
        n = sizes[own]
        at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        bit = (place[at] % np.uint64(64 * w)).astype(np.int64)
        odd = np.bincount(np.repeat(np.arange(len(own)), n) * (64 * w) + bit, minlength=len(own) * 64 * w) & 1
        packed = np.packbits(odd.astype(np.uint8).reshape(len(own), -1), axis=1)
        for i, row in zip(own.tolist(), packed):
            out[i] = row.tobytes()
    return out


def _folded(words: np.ndarray, n: int) -> np.ndarray:
    """Rows of sketches at a smaller length: parities of halves add up."""
    while words.shape[1] > n:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def _may_link(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, bands: Bands) -> np.ndarray:
    """No pair that is linked fails this (rows of equal length, broadcast against one another)."""
    differ = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    return (differ * (bands.den + bands.num) <= (nx + ny) * (bands.den - bands.num)) & (
        bands.den * np.minimum(nx, ny) >= bands.num * np.maximum(nx, ny))


def _by_length(raw: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of each sketch length: (positions, words)."""
    size = np.array([len(r) for r in raw])
    return {n // 8: ((at := np.flatnonzero(size == n)), np.frombuffer(b"".join([raw[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1))
            for n in np.unique(size).tolist()}


def _described(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, cls, sketch) of every row."""
    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        n, cls, sketch = [], [], []
        for lo, hi in text_groups(texts):
            values, sizes = shingle_sets(texts[lo:hi], width)
            n.append(sizes)
            sketch += sketches(values, sizes)
            cls.append(_classes(values, sizes).view(np.int64))
        return {"doc_id": batch.column("doc_id"), "n": np.concatenate(n), "cls": np.concatenate(cls), "sketch": sketch}

    return map_batches(docs, run, "doc_id long, n long, cls long, sketch binary")


def _signed(docs: DataFrame, width: int, bands: Bands) -> DataFrame:
    """(sig, cls): signatures of every class, once per batch it occurs in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Bands(bands.num, bands.den)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in text_groups(texts):
                values, sizes = shingle_sets(texts[lo:hi], width)
                cls = _classes(values, sizes)
                once = np.zeros(len(cls), dtype=bool)
                once[np.unique(cls, return_index=True)[1]] = True
                keep = np.repeat(once, sizes)
                who, sig = signatures(values[keep], np.where(once, sizes, 0), own)
                yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(cls[who].view(np.int64))],
                                                 names=["sig", "cls"])

    return map_arrow(docs.filter(F.col("doc_id").isNotNull()), run, "sig long, cls long")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(doc_id, features) of the documents of ``wanted`` (doc_id, cls)."""
    inside = id_bitmap(wanted, "doc_id")

    def run(batch: pa.RecordBatch) -> dict | None:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        pick = np.flatnonzero(inside(ids))
        if not len(pick):
            return None
        texts = batch.column("text").take(pa.array(pick)).to_pylist()
        sets, cls = [], []
        for lo, hi in text_groups(texts):
            values, sizes = shingle_sets(texts[lo:hi], width)
            cls.append(_classes(values, sizes).view(np.int64))
            sets += [v.tobytes() for v in np.split(values, np.cumsum(sizes)[:-1])]
        return {"doc_id": ids[pick], "cls": np.concatenate(cls), "features": sets}

    found = map_batches(docs.filter(F.col("doc_id").isNotNull()), run, "doc_id long, cls long, features binary")
    return found.join(wanted, ["doc_id", "cls"], "left_semi").select("doc_id", "features")


def _common(docs: DataFrame, wanted: DataFrame, width: int) -> Callable:
    """For use in tasks: the level of each element (0 to LEVELS), by the number of
    sampled sets of ``wanted`` (doc_id, cls) that have it.

    The table has a fixed size; where too many elements are common for it, the
    least common of them count as rare."""
    inside = id_bitmap(wanted.filter(F.pmod(F.xxhash64("cls"), F.lit(SAMPLED)) == 0), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick = np.flatnonzero(inside(batch.column("doc_id").to_numpy()))
            texts = batch.column("text").take(pa.array(pick)).to_pylist()
            for lo, hi in text_groups(texts):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(texts[lo:hi], width)[0].view(np.int64))], names=["h"])

    cell = F.pmod(F.xxhash64("h"), F.lit(CELLS)) + 1
    found = stage_table(map_arrow(docs.filter(F.col("doc_id").isNotNull()), run, "h long").groupBy("h").agg(F.count("*").alias("k")).filter("k > 1")
                        .select(cell.alias("c"), F.least(F.floor((F.log2("k") + 1) / 2), F.lit(LEVELS)).cast("int").alias("level")), "jaccard-common")
    held, least = 0, LEVELS
    for level, k in sorted(found.groupBy("level").count().collect(), reverse=True):
        held += k
        if held <= CELLS // 4:
            least = level
    rows = (found.filter(F.col("level") >= least).groupBy("level", F.bitmap_bucket_number("c").alias("n"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("bits")).collect())
    table = np.zeros(CELLS, dtype=np.uint8)
    for r in sorted(rows, key=lambda r: r["level"]):
        bits = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
        table[(r["n"] - 1) * len(bits) + np.flatnonzero(bits)] = r["level"]
    shared = docs.sparkSession.sparkContext.broadcast(table.tobytes())

    def level_of(values: np.ndarray) -> np.ndarray:
        return np.frombuffer(shared.value, dtype=np.uint8)[(xxhash64_long(values.view(np.int64)) & np.uint64(CELLS - 1)).astype(np.int64)]

    return level_of


def _by_rarest(docs: DataFrame, wanted: DataFrame, width: int, bands: Bands) -> DataFrame:
    """(sig, doc): the rarest elements of the sets of ``wanted`` (doc_id, cls), where several have them."""
    inside, level_of = id_bitmap(wanted, "doc_id"), _common(docs, wanted, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick = np.flatnonzero(inside(batch.column("doc_id").to_numpy()))
            texts = batch.column("text").take(pa.array(pick)).to_pylist()
            for lo, hi in text_groups(texts):
                values, sizes = shingle_sets(texts[lo:hi], width)
                who, element = rarest(values, sizes, level_of(values), bands)
                cls = _classes(values, sizes).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(element.view(np.int64)), pa.array(cls[who])], names=["sig", "cls"])

    rows = shared_keys(map_arrow(docs.filter(F.col("doc_id").isNotNull()), run, "sig long, cls long"), "sig", "cls")
    return rows.join(wanted.select("cls", F.col("doc_id").alias("doc")), "cls").select("sig", "doc")


def _linked(a: np.ndarray, b: np.ndarray, bands: Bands) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return bands.den * both >= bands.num * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """(a, b, linked) of candidate pairs."""
    def run(batch: pa.RecordBatch) -> dict:
        linked = [_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), bands)
                  for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
        return {"a": batch.column("a"), "b": batch.column("b"), "linked": linked}

    joined = (pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("features").alias("y")), "b")
              .join(sets.select(F.col("doc_id").alias("a"), F.col("features").alias("x")), "a"))
    return map_batches(joined.select("a", "b", "x", "y"), run, "a long, b long, linked boolean")


def _distinct_groups(members: DataFrame) -> DataFrame:
    """The rows (sig, doc) of one signature for each set of documents that share one:
    near copies agree on many signatures, each of which says the same."""
    told = members.groupBy("sig").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("doc")).alias("p"),
                                      F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("q"))
    return members.join(told.groupBy("m", "p", "q").agg(F.min("sig").alias("sig")).select("sig"), "sig", "left_semi")


def _passing(pairs: DataFrame, about: DataFrame, bands: Bands) -> DataFrame:
    """The pairs (a, b) that the sketches do not rule out."""
    def run(batch: pa.RecordBatch) -> dict:
        x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        nx, ny = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
        ok = np.zeros(len(x), dtype=bool)
        lengths = np.array([(len(a), len(b)) for a, b in zip(x, y)]).reshape(-1, 2)
        for a, b in {tuple(p) for p in lengths.tolist()}:
            at = np.flatnonzero((lengths == (a, b)).all(axis=1))
            n = min(a, b) // 8
            left, right = (np.frombuffer(b"".join([v[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1) for v in (x, y))
            ok[at] = _may_link(_folded(left, n), _folded(right, n), nx[at], ny[at], bands)
        return {c: batch.column(c).filter(pa.array(ok)) for c in "ab"}

    joined = (pairs.join(about.select(F.col("doc").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("ny")), "b")
              .join(about.select(F.col("doc").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("nx")), "a"))
    return map_batches(joined.select("a", "b", "x", "y", "nx", "ny"), run, "a long, b long")


def _in_blocks(large: DataFrame, about: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (a, b) of different components, within clusters of the given
    (sig, doc, comp) rows, that the sketches do not rule out.

    Groups of a cluster that repeat one another meet as one; those that are but
    chained, so that all of the cluster has more pairs than its groups have,
    meet each on its own.  The least document of either is left out: the
    caller compares it as the centre of a star."""
    large = large.select("sig", "doc", "comp")
    hubs = large.groupBy("sig").agg(F.min("doc").alias("hub"), F.count("*").alias("m"))
    star = large.join(hubs, "sig")
    cluster = connected_components(star.select(F.col("doc").alias("a"), F.col("hub").alias("b")), stage_table)
    size = cluster.groupBy("component").agg(F.count("*").alias("m"))
    hubs = (hubs.join(cluster.withColumnRenamed("node", "hub"), "hub", "left")
            .select("sig", "hub", "m", F.coalesce("component", "hub").alias("component")))
    apart = hubs.groupBy("component").agg(F.sum(F.col("m") * F.col("m")).alias("apart"))
    size = size.join(apart, "component").withColumn("whole", F.col("m") * F.col("m") <= F.col("apart"))
    alone = (large.join(hubs.join(size.filter("NOT whole").select("component"), "component").select("sig", "hub", "m"), "sig")
             .filter("doc != hub").select(F.lit(False).alias("whole"), F.col("sig").alias("component"), F.col("doc").alias("node"), "m"))
    placed = (cluster.join(size.filter("whole"), "component").select("whole", "component", "node", "m").unionByName(alone)
              .withColumn("nb", F.ceil(F.greatest(F.sqrt(F.col("m") / BLOCK), F.col("m") / LARGEST)).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
              .join(large.select(F.col("doc").alias("node"), "comp").distinct(), "node")
              .join(about.withColumnRenamed("doc", "node"), "node")
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("whole", "component", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                      "block", "node", "comp", "n", "sketch"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = pd.concat(list(parts), ignore_index=True)
        nodes, side, comp, n = (part[c].to_numpy() for c in ("node", "block", "comp", "n"))
        lower, upper = (np.flatnonzero(side == part[c].iloc[0]) for c in ("bi", "bj"))
        alone = part["bi"].iloc[0] == part["bj"].iloc[0]  # a block against itself: each pair once
        raw = part["sketch"].tolist()
        del part
        rows, columns = (_by_length([raw[i] for i in own.tolist()]) for own in (lower, upper))
        del raw
        out, held = [], 0
        for w, (at, words) in rows.items():
            for v, (to, others) in columns.items():
                if max(v, w) > bands.reach * min(v, w) or (alone and v < w):
                    continue  # sizes too far apart for a link, or lengths that have met
                short, long = _folded(words, min(v, w)), _folded(others, min(v, w))
                for first in range(0, len(to), PIECE):
                    j, piece = upper[to[first:first + PIECE]], long[first:first + PIECE]
                    step = max(1, (1 << 20) // max(1, piece.size))
                    for lo in range(0, min(len(at), first + len(j)) if alone and v == w else len(at), step):
                        i = lower[at[lo:lo + step]]
                        ok = _may_link(short[lo:lo + step, None], piece[None], n[i][:, None], n[j][None], bands)
                        ok &= comp[i][:, None] != comp[j][None]
                        p, q = np.nonzero(ok)
                        if not len(p):
                            continue
                        out.append(pd.DataFrame({"a": np.minimum(nodes[i[p]], nodes[j[q]]), "b": np.maximum(nodes[i[p]], nodes[j[q]])}))
                        held += len(p)
                        if held >= PAIRS:
                            yield pd.concat(out)
                            out, held = [], 0
        yield pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")
        give_back()

    # by a number of its own: Spark would join small partitions by their bytes, and the work of a block is its pairs
    tasks = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["whole", "component", "bi", "bj"]
    return placed.repartition(tasks, *key).groupBy(*key).applyInPandas(run, "a long, b long")


def join_groups(docs: DataFrame, width: int = WIDTH, numerator: int = NUMERATOR,
                denominator: int = DENOMINATOR) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    bands = Bands(numerator, denominator)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    described = stage_table(_described(docs, width), "jaccard-sets")
    classes = (described.filter("n > 0 AND doc_id IS NOT NULL").groupBy("cls")
               .agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    members = stage_table(shared_keys(_signed(docs, width, bands), "sig", "cls").join(classes.select("cls", "doc"), "cls")
                          .select("sig", "doc", "cls"), "jaccard-signatures")
    about = stage_table(classes.join(members.select("cls").distinct(), "cls"), "jaccard-classes")
    members = stage_table(_distinct_groups(members.select("sig", "doc")), "jaccard-groups")

    def verified(pairs: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        """(links, all) of distinct candidate pairs."""
        passed = stage_table(_passing(pairs, about, bands), f"{name}-passed")
        wanted = passed.select(F.col("a").alias("doc")).unionByName(passed.select(F.col("b").alias("doc"))).distinct()
        wanted = wanted.join(about.select("doc", "cls"), "doc").select(F.col("doc").alias("doc_id"), "cls")
        sets = stage_table(_sets(docs, wanted, width), f"{name}-features")
        checked = stage_table(_verified(passed, sets, bands), f"{name}-checked")
        return checked.filter("linked").select("a", "b"), pairs

    def open_groups(groups: DataFrame, labels: DataFrame | None, name: str) -> DataFrame:
        """(sig, doc, comp, m) of the groups (sig, doc) of m that lie in several components by now."""
        if labels is None:
            now = groups.withColumn("comp", F.col("doc"))
        else:
            now = (groups.join(labels.select(F.col("node").alias("doc"), "component"), "doc", "left")
                   .select("sig", "doc", F.coalesce("component", "doc").alias("comp")))
        spread = now.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
        return stage_table(now.join(spread.filter("lo != hi").select("sig", "m"), "sig"), name)

    def star_pairs(groups: DataFrame, rank: Column) -> DataFrame:
        """The pairs of a group's document of the least rank with those of other components."""
        ranked = groups.withColumn("r", rank)
        centre = (ranked.join(ranked.groupBy("sig").agg(F.min("r").alias("r")), ["sig", "r"])
                  .select("sig", F.col("doc").alias("hub"), F.col("comp").alias("hub_comp")))
        return (groups.join(centre, "sig").filter(F.col("comp") != F.col("hub_comp"))
                .select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")))

    def pair_by_pair(few: DataFrame) -> DataFrame:
        return (few.alias("l").join(few.alias("r"), "sig").filter("l.doc < r.doc AND l.comp != r.comp")
                .select(F.col("l.doc").alias("a"), F.col("r.doc").alias("b")))

    links = tried = None
    for turn in range(STAR_ROUNDS + 1):
        labels = None if links is None else connected_components(links, stage_table)
        unsettled = open_groups(members, labels, f"jaccard-open-{turn}")
        if turn < STAR_ROUNDS:
            # the star's centre: the smallest document first, then another one
            pairs = star_pairs(unsettled, F.col("doc") if turn == 0 else F.xxhash64("doc", F.lit(turn))).distinct()
        else:
            wanted = (unsettled.filter(F.col("m") > SMALL).select("doc").distinct().join(about.select("doc", "cls"), "doc")
                      .select(F.col("doc").alias("doc_id"), "cls"))
            rare = stage_table(_by_rarest(docs, stage_table(wanted, "jaccard-wanted"), width, bands), "jaccard-rarest")
            rare = open_groups(_distinct_groups(rare), labels, "jaccard-open-rarest")
            many = rare.filter(F.col("m") > SMALL)
            pairs = (pair_by_pair(unsettled.filter(F.col("m") <= SMALL)).unionByName(pair_by_pair(rare.filter(F.col("m") <= SMALL)))
                     .unionByName(star_pairs(many, F.col("doc"))).unionByName(_in_blocks(many, about.select("doc", "n", "sketch"), bands)).distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        found, pairs = verified(stage_table(pairs, f"jaccard-pairs-{turn}"), f"jaccard-{turn}")
        links, tried = (found, pairs) if links is None else (links.unionByName(found), tried.unionByName(pairs))

    labels = connected_components(links, stage_table)
    grouped = classes.join(labels, F.col("doc") == F.col("node"), "left").select("cls", F.coalesce("component", "doc").alias("component_id"))
    return (described.join(grouped, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked groups of all ``documents`` on four-word shingles from a similarity of 0.85."""
    return join_groups(read_table(spark, sf_dir, "documents"))
