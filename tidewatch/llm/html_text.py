"""Main text of web pages by tag-path ratios.

A page is read into blocks: runs of text between block-level tags, each with
its tag path from the root (tags with the words of their class and id; inline
tags belong to the block around them).  Per tag path two ratios are summed up
over the page, letters outside links per block and punctuation marks per
block.  They are fused, each against the page's highest, and smoothed from the
root to the leaf: a path inherits half the score of the container it stands
in, so a short heading or list item among paragraphs keeps what its
surroundings say, and the links of a menu do not.  Blocks whose path scores
above a share of the page's mean by letters are the text.

Containers that say what they are (``nav``, ``aside``, ``footer``, a class
``cookie-notice``) count nothing; if the page names its article
(``article``, ``main``, ``itemprop=articleBody``), the rest counts nothing.
A class or id is only believed while something else is left of the page, for a
layout may wrap a whole page in ``has-sidebar``.

Every step is linear in the page, pages of any length are read whole, and a
page depends on itself alone, so there is no shuffle; batches of pages are cut by bytes.

Defined results: null, empty or textless html gives an empty text; a tag, comment
or script that never ends runs to the end of the page; end tags without a start
are ignored; an open quote in the last tag is read as text of that tag only up
to the next ``>``; rows with equal ids are pages of their own; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import read_table

INHERIT = 0.5  # share of a score that comes from the container
THRESHOLD = 0.25  # of the mean score by letters
LETTERS, MARKS = 40.0, 1.0  # ratios at which a path has half of the highest worth, at least

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
REST = re.compile(r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*'|(?!["'])))*+>""")
PLAIN_REST = re.compile(r"[^>]*>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARK = re.compile(r"[.,;:!?…。，、！？；：؟،।]")

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in "script style textarea title iframe noembed noframes xmp".split()}
#: Elements that are never main text.
SKIPPED = frozenset("head nav aside footer menu noscript template dialog select button svg object canvas audio video map math datalist "
                    "script style textarea title iframe noembed noframes xmp".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset(["h1", "h2", "h3"])
#: Words in a class, an id or a role that name something else than main text.
OTHER = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation "
                  "menu menubar topbar breadcrumb breadcrumbs sidebar aside complementary rail footer contentinfo masthead header cookie "
                  "cookies consent gdpr privacy notice alert alertdialog popup modal overlay dialog newsletter subscribe subscription "
                  "signup login paywall share sharing social related recommended recommendations teaser teasers trending popular "
                  "comment comments commentlist comment-list disqus discussion replies respond responses widget widgets toolbar pagination pager "
                  "copyright legal disclaimer skip search searchbox form feedback rating survey hidden".split())
#: Words that name main text.
OWN = frozenset("article content main post entry story text body page wrapper container site".split())
#: Open elements that the start of another one ends: name -> (ended, the containers it stays inside).
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)),
        "tr": (("td", "th", "tr"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): "text", "start" and "end"; comments, declarations and raw contents are left out."""
    at, n, quoted = 0, len(page), True
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", "", page[at:]
            return
        if lt > at:
            yield "text", "", page[at:lt]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
        else:
            closing = page.startswith("</", lt)
            name = NAME.match(page, lt + 1 + closing)
            if not name:
                if closing and lt + 2 < n:  # a bogus comment
                    end = page.find(">", lt)
                    at = n if end < 0 else end + 1
                else:
                    yield "text", "", "<"
                    at = lt + 1
                continue
            rest = REST.match(page, name.end()) if quoted else None
            if rest is None:
                quoted = False  # some quote never closes: from here on tags end at the next ">"
                rest = PLAIN_REST.match(page, name.end())
                if rest is None:
                    return
            at, tag = rest.end(), name.group().lower()
            yield ("end" if closing else "start"), tag, page[name.end():at - 1]
            if not closing and tag in RAW:
                end = RAW[tag].search(page, at)
                at = n if end is None else end.start()


def _hint(name: str, rest: str) -> tuple[str, int]:
    """The words of class and id, and whether they name main text (1), something else (-1, surely: -2) or nothing (0)."""
    if "=" not in rest and "hidden" not in rest:
        return "", 0
    found = {}
    for k, v in ATTRIBUTE.findall(rest):
        found.setdefault(k.lower(), v[1:-1] if v[:1] in "\"'" and v else v)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return "", -2
    role = found.get("role", "").lower()
    if role == "main" or found.get("itemprop", "").lower() == "articlebody":
        return role or "articlebody", 2
    if role in OTHER:
        return role, -2
    own, other, words = False, False, []
    for one in html.unescape(f"{found.get('class', '')} {found.get('id', '')}").split():
        parts = [w.lower() for w in WORDS.findall(one)]
        words += parts
        if one.lower() in OTHER:
            other = True
        elif any(w in OTHER for w in parts):
            other = other or not own
        elif any(w in OWN for w in parts):
            own = True
    if not other:
        return " ".join(words), int(own)
    sure = any(one.lower() in OTHER for one in f"{found.get('class', '')} {found.get('id', '')}".split())
    return " ".join(words), 0 if own and not sure else -1


class Page:
    """Blocks of a page, and its containers by their order of start."""

    def __init__(self, page: str):
        self.parent, self.path, self.kind, self.tag = [-1], [0], [0], ["root"]  # of each container
        self.block_at: list[int] = []  # container of each block
        self.text: list[str] = []
        self.linked: list[int] = []
        self.paths: dict[tuple[int, str], int] = {}
        self._read(page)

    def _read(self, page: str) -> None:
        stack: list[tuple[str, int]] = [("root", 0)]  # name and container; inline elements share the container around them
        open_names: dict[str, int] = {}
        skip = links = 0  # open elements that hide their text; open links
        pieces: list[str] = []
        linked = 0

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join(html.unescape("".join(pieces)).split())
                if text:
                    self.block_at.append(stack[-1][1])
                    self.text.append(text)
                    self.linked.append(min(linked, len(text)))
                pieces.clear()
            linked = 0

        def close() -> None:
            nonlocal skip, links
            name = stack[-1][0]
            if name not in INLINE:
                flush()
            stack.pop()
            open_names[name] -= 1
            skip -= name in SKIPPED
            links -= name == "a"

        for kind, name, rest in tokens(page):
            if kind == "text":
                if not skip:
                    pieces.append(rest)
                    if links:
                        linked += len(rest.strip())
                continue
            if kind == "end":
                if name == "p" and not open_names.get("p"):
                    flush()
                elif open_names.get(name):
                    while stack[-1][0] != name:
                        close()
                    close()
                continue
            if name in VOID:
                if name in ("br", "hr"):
                    pieces.append(" ")
                continue
            if name not in INLINE:
                flush()
                if open_names.get("p"):
                    while stack[-1][0] != "p":
                        close()
                    close()
                if name in ENDS:
                    ended, inside = ENDS[name]
                    while any(open_names.get(e) for e in ended):
                        k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in ended or stack[k][0] in inside), 0)
                        if stack[k][0] not in ended:
                            break
                        while len(stack) > k:
                            close()
                up = stack[-1][1]
                words, hint = _hint(name, rest)
                if name in MAIN and hint >= 0:
                    hint = 2
                key = (self.path[up], f"{name} {words}")
                self.path.append(self.paths.setdefault(key, len(self.paths) + 1))
                self.parent.append(up)
                self.kind.append(hint)
                self.tag.append(name)
                stack.append((name, len(self.parent) - 1))
            else:
                stack.append((name, stack[-1][1]))
            open_names[name] = open_names.get(name, 0) + 1
            skip += name in SKIPPED
            links += name == "a"
        while len(stack) > 1:
            close()
        flush()

    def _counted(self) -> list[bool]:
        """Which blocks take part: not those of containers that name something else, while others are left."""
        n = len(self.parent)
        inside, sure, doubt, header = [False] * n, [False] * n, [False] * n, [False] * n
        for c in range(1, n):
            up = self.parent[c]
            inside[c] = inside[up] or self.kind[c] == 2
            sure[c] = sure[up] or self.kind[c] == -2
            doubt[c] = doubt[up] or self.kind[c] == -1
            header[c] = header[up] or self.tag[c] == "header" or self.tag[c] == "form"
        blocks = range(len(self.text))
        at = self.block_at

        def letters(keep: list[bool]) -> int:
            return sum(len(self.text[b]) - self.linked[b] for b in blocks if keep[b])

        keep = [not sure[at[b]] for b in blocks]
        # a page header or a form holds no main text, unless it holds nearly all there is; the headings of an article's header stay
        rest = [k and (not header[at[b]] or (inside[at[b]] and self.tag[at[b]] in HEADINGS)) for b, k in zip(blocks, keep)]
        keep = rest if letters(rest) else keep
        named = [k and inside[at[b]] and not doubt[at[b]] for b, k in zip(blocks, keep)]
        if any(named):
            return named
        rest = [k and not doubt[at[b]] for b, k in zip(blocks, keep)]
        return rest if letters(rest) else keep

    def main_text(self) -> str:
        counted = self._counted()
        n = len(self.parent)
        # ratios of each tag path, and of each container with all that is below
        per_path: dict[int, list[float]] = {}
        per_node = [[0.0, 0.0, 0.0, 0.0] for _ in range(n)]
        for b, text in enumerate(self.text):
            if counted[b]:
                plain = len(text) - self.linked[b]
                numbers = (plain, len(MARK.findall(text)) * plain / len(text), 1.0, len(text))
                for total in (per_path.setdefault(self.path[self.block_at[b]], [0.0] * 4), per_node[self.block_at[b]]):
                    for i, x in enumerate(numbers):
                        total[i] += x
        if not per_path:
            return ""
        for c in range(n - 1, 0, -1):
            for i, x in enumerate(per_node[c]):
                per_node[self.parent[c]][i] += x
        letters = max(LETTERS, *(t[0] / t[2] for t in per_path.values()))
        marks = max(MARKS, *(t[1] / t[2] for t in per_path.values()))

        def fused(total: list[float]) -> float:
            if not total[2]:
                return 0.0
            a, b = total[0] / total[2] / letters, total[1] / total[2] / marks
            return total[0] / max(1.0, total[3]) * (a + b + (a * b) ** 0.5) / 3

        # scores of containers, from the root to the leaf
        score = [0.0] * n
        score[0] = fused(per_node[0])
        for c in range(1, n):
            score[c] = (1 - INHERIT) * fused(per_node[c]) + INHERIT * score[self.parent[c]]
        own = {p: fused(t) for p, t in per_path.items()}
        value = [(1 - INHERIT) * own[self.path[c]] + INHERIT * score[max(0, self.parent[c])] if counted[b] else 0.0
                 for b, c in enumerate(self.block_at)]
        weight = sum(len(t) for b, t in enumerate(self.text) if counted[b])
        least = THRESHOLD * sum(v * len(t) for v, t in zip(value, self.text)) / weight
        return " ".join(t for b, t in enumerate(self.text) if counted[b] and value[b] >= least)


def main_text(page: str | None) -> str:
    return Page(page).main_text() if page else ""


BATCH_PAGES, BATCH_LETTERS = 256, 8 << 20


def extracted(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the html column."""
    from pyspark.sql.pandas.types import to_arrow_schema

    others = [c for c in pages.columns if c != html_col]
    rows = pages.select(*others, F.col(html_col).cast("string").alias("__html"))
    target = pages.select(*others, F.lit("").alias("text")).schema
    names = to_arrow_schema(target).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = whole.column(len(others))
            at = 0
            texts: list[str] = []
            start = size = 0
            while at < whole.num_rows:
                page = column[at].as_py()
                texts.append(main_text(page))
                at += 1
                size += len(texts[-1])
                if len(texts) == BATCH_PAGES or size > BATCH_LETTERS or at == whole.num_rows:
                    part = whole.slice(start, at - start)
                    yield pa.RecordBatch.from_arrays([*part.columns[:len(others)], pa.array(texts, pa.string())], names=names)
                    texts, start, size = [], at, 0

    return rows.mapInArrow(run, target)


def op13_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return extracted(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
