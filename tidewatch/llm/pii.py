"""Personal data by a skip-chain conditional random field.

Base patterns find addresses of mail and hosts, card and phone numbers.  The
field adds mentions they miss, and secrets: its nodes are the base spans, keyed
values (a long value of letters and digits assigned to a name such as ``token``)
and every other token with an at sign or five digits; neighbouring nodes are
linked in a chain, and distant nodes that repeat or resemble one another (same
text, same digits, same last seven digits, same name before the at sign) share
a skip potential.  Loopy sum-product messages then pull repeated mentions to one
label, so a secret named once is found wherever it is repeated.  Base spans and
keyed values are clamped to their kind; tokens without at sign or five digits
are clamped to "other" and so need no node.

Unary, chain and skip weights are fitted by pseudo-likelihood on those labels in
a bounded sample of documents, with features that leave out what the patterns
themselves test (plus sign, checksum, part sizes).  Hosts, phone numbers and keyed
values are also shown to the fit alone and without their separators or name, as
"other": digits alone make none of them.  A keyed value is shown once more as a
linked repetition without its name.

Defined results: a null text is empty; documents without nodes have no spans;
equal texts have equal spans; repeated rows each get their row; other columns of
the input are not read (``masked`` keeps them); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, map_batches, read_table, whole_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("secret",)
SECRET = len(BASE_KINDS)
OTHER = len(KINDS)  # label of everything else
LABELS = OTHER + 1
SAMPLE_DOCS = 4_000  # documents the weights are fitted on, about
SAMPLE_NODES = 400  # nodes in a row taken from one of them, at most
ROUNDS = 8  # of messages
NEAR = 80  # characters between neighbours of the chain
SEED = 11

# Local parts are taken from the left of each at sign: the class holds no at
# sign, so the leftmost match begins where the run of the class begins.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive runs and the look-behind keep the scans linear and change no match:
# a match that fails from the first digit of a run fails from its others too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGNS = re.compile(r"[0-9@]")
KEYED = re.compile(r"(?<![A-Za-z])(?:key|token|secret|password|passwd|pwd|credential)s?[\"']?\s{0,3}[:=]\s{0,3}[\"']?"
                   r"(?P<value>[A-Za-z0-9_/+.~-]{16,}+)(?!@)", re.IGNORECASE)
TOKEN = re.compile(r"\S+")
DIGITS = re.compile(r"[0-9]")
EDGE = ".,;:!?()[]{}<>\"'"


def emails(text: str) -> list[tuple[int, int]]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    if not SIGNS.search(text):
        return []
    spans = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(DIGITS.findall(m[0])) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def keyed_values(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of values with letters and digits that a name calls a secret, in order."""
    out = []
    for m in KEYED.finditer(text):
        value = m["value"].rstrip(EDGE)
        if len(value) >= 16 and DIGITS.search(value) and any(c.isalpha() for c in value):
            out.append((m.start("value"), SECRET, m.start("value") + len(value)))
    return out


def nodes(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) of the field's nodes; label OTHER: neither a base span nor a keyed value."""
    out = [(s, e, k) for s, k, e in base]
    if not SIGNS.search(text):
        return out
    out += [(s, e, k) for s, k, e in keyed_values(text)]
    taken = np.zeros(len(text) + 1, dtype=bool)
    for s, e, _ in out:
        taken[s:e] = True
    found = [(m.start(), m.end()) for p in (PHONE, CARD) for m in p.finditer(text) if len(DIGITS.findall(m[0])) >= 7
             and not text[max(0, m.start() - 1):m.start()].isalpha() and not text[m.end():m.end() + 1].isalpha()]
    for m in TOKEN.finditer(text):
        raw = m[0]
        if SIGNS.search(raw) and ("@" in raw or len(DIGITS.findall(raw)) >= 5):
            left = len(raw) - len(raw.lstrip(EDGE))
            found.append((m.start() + left, m.start() + max(left + 1, len(raw.rstrip(EDGE)))))
    for s, e in found:  # longer readings first: numbers in groups before single tokens
        if s < e and not taken[s:e].any():
            taken[s:e] = True
            out.append((s, e, OTHER))
    return sorted(out)


def features(raw: str, before: str, named: bool = False) -> list[float]:
    """Of one node: counts and shape, without the tests of the patterns."""
    n = len(DIGITS.findall(raw))
    dots, seps = raw.count("."), raw.count("-") + raw.count(" ") + raw.count("(") + raw.count("/")
    letters = sum(c.isalpha() for c in raw)
    return [1.0, float("@" in raw), float(n >= 7), float(n >= 10), float(n >= 14), float(n > 15), float(dots == 3),
            float(dots > 0), float(seps >= 2), float(seps >= 1), float(letters > 0), float(letters > n),
            float(before.endswith((":", "="))), float(len(raw) > 25), float(named)]


N_FEATURES = len(features("", ""))
SIGNATURE = [6, 7, 8, 9, 14]  # features of dots, separators and names
BARE = (1, 3, SECRET)  # kinds that are nothing without theirs


def keys(raw: str) -> list[str]:
    """Nodes that share a key are linked by a skip edge."""
    digits = "".join(DIGITS.findall(raw))
    out = ["=" + raw.lower()]
    if len(digits) >= 7:
        out += ["#" + digits, "~" + digits[-7:]]
    if "@" in raw:
        out.append("@" + raw.split("@")[0].lower())
    return out


def graph(text: str, own: list[tuple[int, int, int]]) -> tuple[np.ndarray, list[tuple[int, int]], list[tuple[int, int]]]:
    """Features, chain edges and skip edges.  A node is linked to the last
    earlier node of each of its keys, so a group of m mentions has m - 1 links."""
    x = np.array([features(text[s:e], text[max(0, s - 2):s].rstrip(), k == SECRET) for s, e, k in own]).reshape(-1, N_FEATURES)
    chain = [(i, i + 1) for i in range(len(own) - 1) if own[i + 1][0] - own[i][1] <= NEAR]
    last: dict[str, int] = {}
    skip = set()
    for i, (s, e, _) in enumerate(own):
        for k in keys(text[s:e]):
            if k in last:
                skip.add((last[k], i))
            last[k] = i
    return x, chain, sorted(skip)


class Field:
    """Weights of the field: unary (features x labels), chain and skip (labels x labels)."""

    def __init__(self, unary: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.unary, self.chain, self.skip = unary, chain, skip

    def marginals(self, x: np.ndarray, chain: list, skip: list, fixed: np.ndarray) -> np.ndarray:
        """Label probabilities after loopy messages; ``fixed`` labels below OTHER are clamped."""
        own = x @ self.unary
        clamp = fixed < OTHER
        own[clamp] = -40.0
        own[clamp, fixed[clamp]] = 40.0
        edges = np.array(chain + skip, dtype=np.int64).reshape(-1, 2)
        if not len(edges):
            return _softmax(own)
        table = np.concatenate([np.repeat(self.chain[None], len(chain), axis=0), np.repeat(self.skip[None], len(skip), axis=0)])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        table = np.concatenate([table, table.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, messages)
            sent = belief[source] - messages[back]
            fresh = _logsum(sent[:, :, None] + table)
            fresh -= fresh.max(axis=1, keepdims=True)
            messages = 0.5 * messages + 0.5 * fresh  # damped
        belief = own.copy()
        np.add.at(belief, target, messages)
        return _softmax(belief)

    def spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Base spans, keyed values and the spans the field adds."""
        own = nodes(text, base)
        label = np.array([k for _, _, k in own], dtype=np.int64)
        known = sorted((s, k, e) for s, e, k in own if k != OTHER)
        if len(known) == len(own):
            return known
        x, chain, skip = graph(text, own)
        p = self.marginals(x, chain, skip, label)
        best = p.argmax(axis=1)
        return sorted(known + [(s, int(b), e) for (s, e, k), b in zip(own, best) if k == OTHER and b != OTHER])


def _softmax(a: np.ndarray) -> np.ndarray:
    p = np.exp(a - a.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _logsum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=1, keepdims=True)))[:, 0]


def fit(x: np.ndarray, label: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 300, rate: float = 0.5,
        decay: float = 0.02) -> Field:
    """Pseudo-likelihood: each node's label given its features and its neighbours' labels."""
    hot = np.eye(LABELS)[label]
    near = np.zeros_like(hot)
    far = np.zeros_like(hot)
    for edges, into in ((chain, near), (skip, far)):
        for a, b in ((0, 1), (1, 0)):
            if len(edges):
                np.add.at(into, edges[:, a], hot[edges[:, b]])
    unary, pair, jump = np.zeros((N_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.eye(LABELS)
    n = max(1, len(x))
    for _ in range(steps if len(x) else 0):
        gap = (_softmax(x @ unary + near @ pair + far @ jump) - hot) / n
        unary -= rate * (x.T @ gap + decay * unary)
        pair -= rate * (near.T @ gap + decay * pair)
        jump -= rate * (far.T @ gap + decay * (jump - 3 * np.eye(LABELS)))  # prior: repeated mentions agree
        pair, jump = (pair + pair.T) / 2, (jump + jump.T) / 2
    return Field(unary, pair, jump)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = SEED) -> Field:
    """Weights from about ``sample_docs`` documents, chosen by a hash of doc_id and text (so copies
    come in proportion) and each once; a long one gives ``SAMPLE_NODES`` neighbouring nodes, from a
    place that its text decides, so the rows that come back are bounded."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    n = rows.count()
    if n > sample_docs:
        unit = F.xxhash64("doc_id", "text", F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1))
        rows = rows.filter(unit < int((1 << 53) * (sample_docs / n)))
    rows = rows.distinct()

    def run(batch: pa.RecordBatch) -> dict | None:
        out = {"x": [], "label": [], "chain": [], "skip": []}
        for text in batch.column("text").to_pylist():
            own = nodes(text, base_spans(text))
            if len(own) > SAMPLE_NODES:
                first = zlib.crc32(text.encode()) % (len(own) - SAMPLE_NODES + 1)
                own = own[first:first + SAMPLE_NODES]
            if own:
                x, chain, skip = graph(text, own)
                bare = x[[k in BARE for _, _, k in own]]
                bare[:, SIGNATURE] = 0.0  # linked with nothing
                secret = [i for i, (_, _, k) in enumerate(own) if k == SECRET]
                again = x[secret]
                again[:, SIGNATURE] = 0.0  # a repetition without the name, linked with the keyed value
                skip += [(i, len(own) + len(bare) + j) for j, i in enumerate(secret)]
                x = np.concatenate([x, bare, again])
                own = own + [(0, 0, OTHER)] * len(bare) + [(0, 0, SECRET)] * len(again)
                for name, value in (("x", x), ("label", [k for _, _, k in own]), ("chain", chain), ("skip", skip)):
                    out[name].append(np.asarray(value).ravel())
        return out if out["x"] else None

    got = map_batches(rows, run, "x array<double>, label array<int>, chain array<int>, skip array<int>").collect()
    got.sort(key=lambda r: (r["x"], r["label"]))
    x, label, chain, skip, shift = [], [], [], [], 0
    for r in got:
        x.append(np.array(r["x"]).reshape(-1, N_FEATURES))
        label += r["label"]
        chain.append(np.array(r["chain"], dtype=np.int64).reshape(-1, 2) + shift)
        skip.append(np.array(r["skip"], dtype=np.int64).reshape(-1, 2) + shift)
        shift += len(r["label"])
    none = [np.zeros((0, 2), dtype=np.int64)]
    return fit(np.concatenate([np.zeros((0, N_FEATURES)), *x]), np.array(label, dtype=np.int64),
               np.concatenate(none + chain), np.concatenate(none + skip))


def find(docs: DataFrame, field: Field) -> DataFrame:
    """Counts and digest of the base spans, all spans and their number, of every row."""
    def run(batch: pa.RecordBatch) -> dict:
        counts = [[] for _ in BASE_KINDS]
        digest, spans, n_spans = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text)
            for k, column in enumerate(counts):
                column.append(sum(s[1] == k for s in base))
            digest.append(hashlib.sha256(spell(base).encode()).hexdigest())
            found = field.spans(text, base)
            spans.append(spell(found))
            n_spans.append(len(found))
        return {"doc_id": batch.column("doc_id"), **{f"n_{k}": c for k, c in zip(BASE_KINDS, counts)},
                "base_sha256": digest, "spans": spans, "n_spans": n_spans}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), run,
                       "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def masked(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` to match; null texts stay null."""
    columns = docs.columns

    def run(batches):
        for batch in batches:
            texts = [None if t is None else redact(t, field.spans(t, base_spans(t)))
                     for t in batch.column("text").to_pylist()]
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    out = map_arrow(docs, run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    return find(docs, train(docs))
