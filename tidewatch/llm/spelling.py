"""Spelling variants of words, found with a frequency-vector trie.

The alphabet is dealt into letter groups of about equal weight; a word is the
vector of its counts per group, and a trie arranges the words by one count
after another.  One inserted letter raises one count by one, one replaced
letter raises one and lowers another (or none, inside a group).  So a word
looks for its near words depth first with a budget of one surplus and one
deficit, the surplus first: that finds each near pair from one side only, an
insertion from the shorter word.  The words of the leaves reached are verified
letter by letter.

On the cluster the first levels of the trie are the key of a shuffle: a word
goes to its own key as a member and to the keys its budget reaches (1 + L +
L(L-1)/2 of L levels) as a query, with the budget that is left.  L is the least
number of levels that leaves no more than KEY_WORDS members under a key; keys
that are larger even on the deepest such level are met block against block.
Below the key, one search carries all queries of a key through the trie at once.

Words travel as Latin-1 bytes (one byte a letter, in code-point order).

Defined results: a null text has no words; a null doc_id counts as an empty
text in ``<doc_id>:<run>``; rows that repeat a doc_id each count; words of any
length take part; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches, read_table
from tidewatch.session import stage_table

LEAST_LETTERS, LEAST_COUNT = 7, 2
DAMAGE = 31  # one run in so many loses a letter
FACTOR = 10  # a form is at least so many times as frequent
GROUPS = 16  # letter groups: levels of the trie
KEY_LEVELS = range(3, 9)  # levels that may make up the shuffle key (a byte each)
KEY_WORDS = 20_000  # members, and queries, that meet in one group of rows
KEY_BYTES = 16 << 20  # and their letters
LEAF_PAIRS = 4_096  # a node with fewer (query, word) pairs is tested at once
WIDE = 64  # longer words are compared one by one
HELD_WORDS, HELD_BYTES = 200_000, 32 << 20  # counts that a task holds before it passes them on

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def damaged(word: bytes, h: int) -> bytes:
    """The word without its letter number h mod length, where DAMAGE divides h."""
    if h % DAMAGE:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(word binary, n): partial sums are made in the tasks, so a frequent word is one row a task."""
    runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % least_letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        held = 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["word", "n"])

        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                part = whole.slice(at, 100)
                for i, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    raw = text.encode("latin-1", "replace").translate(LOWER)  # other letters become "?"
                    seed = zlib.crc32(b"%s:" % i.encode())
                    held += len(raw)
                    for word, n in Counter(runs.findall(raw)).items():
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                        if h % DAMAGE == 0:
                            word = damaged(word, h)
                            if len(word) < least_letters:
                                continue
                        found[word] += n
                if len(found) >= HELD_WORDS or held >= HELD_BYTES:
                    yield rows()
                    found.clear()
                    held = 0
        yield rows()

    texts = docs.filter(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words as one buffer of letters, with their vectors of group counts."""

    def __init__(self, words: pa.Array, groups: np.ndarray):
        words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
        self.n = len(words)
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + self.n + 1] if self.n else np.zeros(1, np.int32)
        data = words.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.letters = raw[offsets[0]:offsets[-1]]
        self.start = (offsets[:-1] - offsets[0]).astype(np.int64)
        self.length = np.diff(offsets).astype(np.int64)
        row = np.repeat(np.arange(self.n), self.length)
        self.vectors = np.bincount(row * GROUPS + groups[self.letters], minlength=self.n * GROUPS).reshape(self.n, GROUPS).astype(np.int32)

    def word(self, i: int) -> bytes:
        return self.letters[self.start[i]:self.start[i] + self.length[i]].tobytes()

    def matrix(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Letters of some words, filled up with zeros."""
        col = np.arange(width)
        at = np.minimum(self.start[rows][:, None] + col, max(0, len(self.letters) - 1))
        return np.where(col < self.length[rows][:, None], self.letters[at], 0)


def letter_groups(words: DataFrame) -> np.ndarray:
    """Group of each letter: letters by falling frequency, each to the lightest group so far;
    the heaviest groups come first in the trie.  Reads at most 256 counts back."""
    def run(batch: pa.RecordBatch) -> dict:
        own = np.bincount(Words(batch.column("word"), np.zeros(256, np.uint8)).letters, minlength=256)
        return {"letter": np.flatnonzero(own), "n": own[own > 0]}

    rows = map_batches(words.select("word"), run, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    weight, group = [0] * GROUPS, np.zeros(256, dtype=np.uint8)
    for r in sorted(rows, key=lambda r: (-r["n"], r["letter"])):
        g = weight.index(min(weight))
        weight[g] += r["n"]
        group[r["letter"]] = g
    order = sorted(range(GROUPS), key=lambda g: (-weight[g], g))
    return np.argsort(order)[group].astype(np.uint8)


def _packed(vectors: np.ndarray, levels: int) -> np.ndarray:
    """The first counts, one byte each (modulo 256: the search compares whole vectors)."""
    key = np.zeros(len(vectors), dtype=np.uint64)
    for i in range(levels):
        key |= (vectors[:, i] & 255).astype(np.uint64) << np.uint64(8 * i)
    return key.view(np.int64)


def _reached(vectors: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys that each word's budget reaches (words by probes), and what each probe has spent."""
    keys, spent = [], []

    def probe(up: int | None, down: int | None) -> None:
        moved = vectors[:, :levels].copy()
        for level, by in ((up, 1), (down, -1)):
            if level is not None:
                moved[:, level] += by
        keys.append(_packed(moved, levels))
        spent.append((up is not None) + (down is not None))

    probe(None, None)
    for up in range(levels):
        probe(up, None)
        for down in range(up + 1, levels):
            probe(up, down)
    return np.stack(keys, axis=1), np.asarray(spent, dtype=np.int32)


def search(members: Words, queries: Words, spent: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, member) candidates within the budget, by a depth-first walk of the members' trie from level ``first``.

    ``spent`` per query: 0 nothing, 1 the surplus, 2 surplus and deficit."""
    order = np.lexsort(members.vectors[:, ::-1].T)
    have, want = members.vectors[order], queries.vectors
    sign = (1 << np.arange(GROUPS)[::-1]).astype(np.int64)
    stack = [(first, 0, members.n, np.arange(queries.n), spent)]
    while stack:
        level, lo, hi, q, s = stack.pop()
        if not len(q) or lo == hi:
            continue
        if (hi - lo) * len(q) <= LEAF_PAIRS:
            diff = have[None, lo:hi] - want[q][:, None]
            size, total = np.abs(diff).sum(axis=2), diff.sum(axis=2)
            near = (size == 0) | ((size == 1) & (total == 1)) | ((size == 2) & (total == 0) & (diff @ sign > 0))
            a, b = np.nonzero(near)
            yield q[a], order[lo + b]
        elif level == GROUPS:
            yield from _halves(members, queries, order[lo:hi], q)
        else:
            values, at = np.unique(have[lo:hi, level], return_index=True)
            ends = np.append(at[1:], hi - lo)
            own = want[q, level]
            for v, x, y in zip(values, at, ends):
                step = v - own
                keep = (step == 0) | ((step == 1) & (s == 0)) | ((step == -1) & (s == 1))
                stack.append((level + 1, lo + x, lo + y, q[keep], (s + (step != 0))[keep]))


def _halves(members: Words, queries: Words, rows: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates of a crowded leaf (all vectors within budget): near words agree in the query's first or last half."""
    def halves(word: bytes, n: int) -> tuple[bytes, bytes]:
        return word[:n // 2], word[len(word) - (n - n // 2):]

    words = {int(i): queries.word(i) for i in q}
    for n in sorted({len(w) for w in words.values()}):
        table: dict = {}
        for m in rows:
            if members.length[m] - n in (0, 1):
                for side, half in enumerate(halves(members.word(m), n)):
                    table.setdefault((side, half), []).append(int(m))
        for i, word in words.items():
            if len(word) == n:
                first, last = halves(word, n)
                found = set(table.get((0, first), ())) | set(table.get((1, last), ()))
                if found:
                    yield np.full(len(found), i), np.fromiter(sorted(found), dtype=np.int64)


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether b is a with one code point replaced or one inserted."""
    if len(b) - len(a) not in (0, 1):
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1:] == b[p + 1:] and p < len(a) if len(a) == len(b) else a[p:] == b[p + 1:]


def verified(members: Words, queries: Words, q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Which candidate pairs differ by exactly one replaced or (in the member) one inserted code point."""
    grown = members.length[m] - queries.length[q]
    out = np.zeros(len(q), dtype=bool)
    long = members.length[m] > WIDE
    for i in np.flatnonzero(long):
        out[i] = one_apart(queries.word(q[i]), members.word(m[i]))
    for by in (0, 1):
        rows = np.flatnonzero((grown == by) & ~long)
        for at in range(0, len(rows), 50_000):
            pick = rows[at:at + 50_000]
            width = int(members.length[m[pick]].max())
            a, b = queries.matrix(q[pick], width), members.matrix(m[pick], width)
            if by == 0:
                out[pick] = (a != b).sum(axis=1) == 1
            else:  # equal letters up to some place, and equal ones shifted by one from there
                n = queries.length[q[pick]]
                inside = np.arange(width - 1) < n[:, None]
                early, late = inside & (a[:, :-1] != b[:, :-1]), inside & (a[:, :-1] != b[:, 1:])
                head = np.where(early.any(axis=1), early.argmax(axis=1), n)
                tail = np.where(late.any(axis=1), width - 1 - late[:, ::-1].argmax(axis=1), 0)
                out[pick] = tail <= head
    return out


def _pairs(members: Words, queries: Words, spent: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (query, member) of a group of rows, each once."""
    kept, waiting, n = [], [], 0

    def settle() -> None:
        if waiting:
            q, m = (np.concatenate(x) for x in zip(*waiting))
            ok = verified(members, queries, q, m)
            q, m = q[ok], m[ok]
            # two words of one vector meet from both sides: keep the smaller one's
            twin = (members.vectors[m] == queries.vectors[q]).all(axis=1)
            drop = [i for i in np.flatnonzero(twin) if queries.word(q[i]) > members.word(m[i])]
            kept.append((np.delete(q, drop), np.delete(m, drop)))
            waiting.clear()

    for pair in search(members, queries, spent, first):
        if len(pair[0]):
            waiting.append(pair)
            n += len(pair[0])
            if n >= 200_000:
                settle()
                n = 0
    settle()
    if not kept:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*kept))


def _summary(words: pa.Array, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict:
    """Per word a: how many near words b, and the first of them by falling n, then by code points."""
    names = words.to_pylist()
    rank = np.empty(len(names), dtype=np.int64)
    rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
    order = np.lexsort([rank[b], -n[b], a])
    a, b = a[order], b[order]
    own, at, times = np.unique(a, return_index=True, return_counts=True)
    best = b[at]
    return {"word": words.take(pa.array(own)), "n_near": times, "best_n": n[best], "best": words.take(pa.array(best))}


def _key_levels(words: DataFrame, groups: np.ndarray) -> int:
    """The least number of levels under which no key has more than KEY_WORDS members, else the deepest."""
    deepest = KEY_LEVELS[-1]

    def run(batch: pa.RecordBatch) -> dict:
        key, n = np.unique(_packed(Words(batch.column("word"), groups).vectors, deepest), return_counts=True)
        return {"key": key, "n": n}

    keys = map_batches(words.select("word"), run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    levels = F.explode(F.array(*[F.lit(i) for i in KEY_LEVELS]))
    mask = F.when(F.col("levels") == 8, F.lit(-1)).otherwise(F.expr("shiftleft(1L, 8 * levels) - 1"))
    sizes = (keys.select("key", "n", levels.alias("levels")).groupBy("levels", F.col("key").bitwiseAND(mask).alias("key"))
             .agg(F.sum("n").alias("n")).groupBy("levels").agg(F.max("n").alias("n")).collect())
    fit = [r["levels"] for r in sizes if r["n"] <= KEY_WORDS]
    return min(fit, default=deepest)


def near_words(words: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> DataFrame:
    """(word, n_near, best_n, best) of the ``words`` (word binary, n; distinct) that have near words."""
    groups = letter_groups(words)
    levels = _key_levels(words, groups)

    def sizes(batch: pa.RecordBatch) -> dict:
        own = Words(batch.column("word"), groups)
        keys, _ = _reached(own.vectors, levels)
        flat = np.concatenate([keys[:, 0], keys.ravel()])
        found, back = np.unique(flat, return_inverse=True)
        weight = np.concatenate([own.length, np.repeat(own.length, keys.shape[1])])
        return {"key": found, "members": np.bincount(back[:own.n], minlength=len(found)),
                "queries": np.bincount(back[own.n:], minlength=len(found)), "bytes": np.bincount(back, weights=weight).astype(np.int64)}

    def parts(rows: str) -> F.Column:
        return F.greatest(F.ceil(F.col(rows) / KEY_WORDS), F.ceil(F.col("bytes") / KEY_BYTES))

    crowded = stage(map_batches(words.select("word"), sizes, "key long, members long, queries long, bytes long").groupBy("key")
                    .agg(*[F.sum(c).alias(c) for c in ("members", "queries", "bytes")])
                    .filter(f"members > {KEY_WORDS} or queries > {KEY_WORDS} or bytes > {KEY_BYTES}")
                    .select("key", parts("members").alias("m_parts"), parts("queries").alias("q_parts")), "spelling-crowded")

    def probes(batch: pa.RecordBatch) -> dict:
        own = Words(batch.column("word"), groups)
        keys, spent = _reached(own.vectors, levels)
        row = np.concatenate([np.arange(own.n), np.repeat(np.arange(own.n), keys.shape[1])])
        take = pa.array(row)
        return {"key": np.concatenate([keys[:, 0], keys.ravel()]), "word": batch.column("word").take(take), "n": batch.column("n").take(take),
                "spent": np.concatenate([np.full(own.n, -1, dtype=np.int32), np.tile(spent, own.n)])}

    rows = map_batches(words.select("word", "n"), probes, "key long, word binary, n long, spent int").join(crowded, "key", "left")
    # a crowded key: members and queries in blocks, each block of one side with each of the other
    own = F.pmod(F.xxhash64("word"), F.when(F.col("spent") < 0, F.col("m_parts")).otherwise(F.col("q_parts")))
    every = F.sequence(F.lit(0), F.when(F.col("spent") < 0, F.col("q_parts")).otherwise(F.col("m_parts")) - 1)
    rows = rows.select("key", "word", "n", "spent", F.coalesce(own, F.lit(0)).alias("own"),
                       F.explode(F.coalesce(every, F.array(F.lit(0).cast("bigint")))).alias("other"))
    member = F.col("spent") < 0
    rows = rows.select("key", F.when(member, F.col("own")).otherwise(F.col("other")).alias("m_part"),
                       F.when(member, F.col("other")).otherwise(F.col("own")).alias("q_part"), "word", "n", "spent")

    def meet(table: pa.Table) -> pa.Table:
        spent = table.column("spent").to_numpy()
        is_member = spent < 0
        at = np.argsort(~is_member, kind="stable")
        names = table.column("word").combine_chunks().take(pa.array(at))
        n = table.column("n").to_numpy()[at]
        count = int(is_member.sum())
        members, queries = Words(names.take(pa.array(np.arange(count))), groups), Words(names.take(pa.array(np.arange(count, len(at)))), groups)
        q, m = _pairs(members, queries, spent[at][count:], levels)
        found = _summary(names, n, np.concatenate([q + count, m]), np.concatenate([m, q + count]))
        return pa.table({"word": found["word"], "n_near": pa.array(found["n_near"], pa.int64()),
                         "best_n": pa.array(found["best_n"], pa.int64()), "best": found["best"]})

    found = rows.groupBy("key", "m_part", "q_part").applyInArrow(meet, "word binary, n_near long, best_n long, best binary")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best")


def variant_groups(words: DataFrame, factor: int = FACTOR, stage: Callable[[DataFrame, str], DataFrame] = stage_table) -> DataFrame:
    """(word, form, root, n, n_near, form_n), words as binary.

    A form is ``factor`` times as frequent as its word, so chains of forms have at most log(largest n) links;
    each round doubles the links followed.  A root gathers only the words one letter around it, step by step."""
    near = near_words(words, stage)
    is_form = F.col("best_n") >= factor * F.col("n")
    linked = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = linked.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "spelling-roots")
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return linked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of at least seven letters that occurs at least twice in ``documents``."""
    words = stage_table(word_counts(read_table(spark, sf_dir, "documents")).filter(F.col("n") >= LEAST_COUNT), "spelling-words")
    text = [F.decode(c, "ISO-8859-1").alias(c) for c in ("word", "form", "root")]
    return variant_groups(words).select(*text, "n", "n_near", "form_n")
