from __future__ import annotations

import html
import re
import time

import pandas as pd
import pytest

from tests.llm.helpers import table_dir
from tests.conftest import SF01
from tidewatch.llm.html_text import main_text, op13_html, tokens

P1 = "The river rose by two metres overnight, and the lower town was cut off; boats carried people to the school."
P2 = "Officials said the dam held. Nobody was hurt, although forty houses lost power, water and their gardens."
P3 = "By noon the rain had stopped, the market reopened, and the first buses ran again on the northern road."
H = "Flood in the lower town"
ITEMS = ["Bring water.", "Stay on the hill, if you can.", "Call the school first."]
LINKS = "".join(f'<li><a href="/{w}">{w.title()} news</a></li>' for w in ("home", "world", "sport", "money", "culture"))
MENU = f"<ul>{LINKS}</ul>"
COMMENTS = "".join(f"<li><p>{t}</p></li>" for t in ("I was there, and it was worse than you say!", "Thanks, great report. My street is dry.", "Who paid for the dam?"))
BODY = f"<h1>{H}</h1><p>{P1}</p><p>{P2}</p><ul>{''.join(f'<li>{i}</li>' for i in ITEMS)}</ul><p>{P3}</p>"
TEXT = " ".join([H, P1, P2, *ITEMS, P3])
HEAD = "<!DOCTYPE html><html><head><title>Flood | News</title><style>p{margin:0}</style><script>var a='<p>no</p>';</script></head><body>"

PAGES = {
    "semantic": f"{HEAD}<header><h2>The Daily</h2>{MENU}</header><nav>{MENU}</nav><main><article>{BODY}</article></main>"
                f"<aside><p>{P2[::-1]}, and more.</p></aside><footer>&copy; 2024 The Daily, all rights reserved.</footer></body></html>",
    "classes": f"{HEAD}<div id='top-menu'>{MENU}</div><div class='cookie-notice'><p>We use cookies, ours and others', to improve this page.</p></div>"
               f"<div id='content'><div class='post-body'>{BODY}</div><div class='share-buttons'>Share, like, print.</div>"
               f"<div id='comments'><h3>Comments</h3><ol class='commentlist'>{COMMENTS}</ol></div></div>"
               f"<div class='sidebar'><h3>About</h3><p>We are a paper, since 1901, of this town.</p></div><div id='footer'><p>Imprint, terms, contact.</p></div>",
    "no names": f"{HEAD}<div><div>{MENU}</div><div>{BODY}</div><div>{MENU}</div></div></body></html>",
    "flat": f"{HEAD}{MENU}{BODY}<hr>{MENU}</body></html>",
    "table layout": f"{HEAD}<table><tr><td>{MENU}<td>{BODY}<tr><td colspan=2>{MENU}</table>",
    "page in a form": f"{HEAD}<form id='aspnetForm' method=post><input name=x><div>{MENU}</div><div>{BODY}</div></form></body></html>",
    "form, advert, comments in the article": f"{HEAD}<article><header><h1>{H}</h1><p>By our reporter, Monday.</p></header>{BODY.replace(f'<h1>{H}</h1>', '')}"
        f"<div class=ad>Buy two boats, pay one!</div><form><label>Your mail</label><input><button>Send</button></form><section class='comments'>{COMMENTS}</section>"
        "<footer>Filed under <a href=x>floods</a>.</footer></article>",
    "wrapper with a side bar": f"{HEAD}<div class='wrapper has-sidebar'><div class='header'>{MENU}</div><div class='entry'>{BODY}</div>"
                               f"<div class='related-posts'><h4>Read on</h4>{MENU}</div></div>",
    "hidden": f"{HEAD}<main>{BODY}<div hidden><p>{P1[::-1]}</p></div><div style='display: none'>{P2[::-1]}</div><p aria-hidden=true>{P3[::-1]}</p></main>",
    "links inside paragraphs": f"{HEAD}<div>{MENU}</div><div>{BODY.replace('dam held', '<a href=x>dam</a> <b>h</b>eld').replace('the market', '<a href=m>the <i>market</i></a>')}</div>",
    "cut off": f"{HEAD}<nav>{MENU}</nav><article>{BODY}</article><footer>&copy; The Da",
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    assert main_text(PAGES[name]) == TEXT


def test_references_white_space_and_broken_markup():
    page = "<article><p><b>a&amp;b &lt;c&gt;\n\t &eacute;&#8364;&#x41;<br>next&nbsp;one <i>in</i>side</article>"
    assert main_text(page) == "a&b <c> é€A next one inside"
    assert main_text("<article>1 < 2 and 3 > 2, <p>so</p></b></article>") == "1 < 2 and 3 > 2, so"
    assert main_text("<") == "<" and main_text("</") == "</"  # no tags
    assert main_text("plain, without any tag") == "plain, without any tag"
    assert main_text('<article><p title="a > b">kept, both</p><p>last, words <a href="x') == "kept, both last, words"
    assert main_text("<article>one.<!-- <p>no</p> --><SCRIPT>x < y </p></SCRIPT><p>two.</article>") == "one. two."


@pytest.mark.parametrize("page", [None, "", "   ", "<p", "<!--", "<script>", "<html></html>", "<nav>x</nav>", "&nbsp;"])
def test_nothing_to_extract(page):
    assert main_text(page) == ""


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "deep, text" + "</div>" * 50_000, '<a "' * 50_000, "<p" * 100_000, "<a href='" * 50_000,
                                  "<li><ul>" * 50_000, "<b><p>x" * 30_000, "</x>" * 100_000, "&amp" * 200_000, "<!" * 100_000, "</" * 100_000,
                                  "<a =" * 60_000, "<td><li>" * 50_000])
def test_linear_on_odd_pages(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 8


def test_tokens_keep_all_text():
    page = "a<b x='>'>c</b><!-- d --><br/>e<script>f</script>g"
    assert [t for t in tokens(page) if t[0] == "text"] == [("text", "", x) for x in "aceg"]


def test_query_on_all_pages(spark):
    rows = op13_html(spark, SF01)
    assert rows.columns == ["page_id", "url", "text", "n_chars"]
    found = {r["page_id"]: r for r in rows.collect()}
    pages = spark.read.parquet(f"{SF01}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)(</article>|\Z)", page["html"], re.S).group(1)
        inside = re.sub(r"<[^>]*(>|\Z)", " ", re.sub(r"</?[ab](\s[^>]*)?>", "", article))
        assert found[page["page_id"]]["text"] == " ".join(html.unescape(inside).split())
        assert found[page["page_id"]]["n_chars"] == len(found[page["page_id"]]["text"]) and found[page["page_id"]]["url"] == page["url"]


def test_nulls_repeats_and_extra_columns(spark, tmp_path):
    df = pd.DataFrame({"page_id": [1, 1, None, 4], "url": ["u", "u", None, "v"], "html": [PAGES["flat"], PAGES["flat"], None, "<p>long, "
                       + "word " * 400_000], "text": ["x"] * 4, "n_chars": [7] * 4, "__html": ["y"] * 4})
    df["page_id"] = df["page_id"].astype("Int64")
    rows = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in op13_html(spark, table_dir(tmp_path, pages=df)).collect()))
    assert rows[0] == (0, None, "", 0) and rows[1:3] == [(1, "u", TEXT, len(TEXT))] * 2
    assert rows[3][3] == len("long, " + "word " * 400_000) - 1


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert op13_html(spark, table_dir(tmp_path, pages=df)).collect() == []
