"""Main text of web pages: flat text blocks with the word count and link density of each and of its neighbours, and
what the markup around it says, classified by a decision tree that is trained on a small labelled table.

A page is read once from front to back, whatever is broken in it. Tags end at their ``>``, or where the next tag begins;
comments and the standard's raw-text elements are skipped to their end, and where that is missing only what stands before
the next tag is lost. The labelled table has small pages in the shape of real ones, line by line with what belongs to the
text; the tree is grown on the features of their blocks.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fieldspark.llm.shared import Packed, spread, table

# Elements of HTML by what they do to text blocks. Raw text is skipped to its end tag; so are controls that
# have one before the next of their kind.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
CONTROLS = {"select", "button", "datalist"}
CONTAINERS = {"html", "body", "article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl", "menu", "table", "thead", "tbody", "tfoot", "tr", "blockquote", "pre", "figure", "figcaption", "fieldset", "details", "dialog", "address", "center", "hgroup", "search", "noscript", "template"}
LEAVES = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "caption", "summary", "legend"}
BREAKS = {"br", "hr", "option", "optgroup"}
MAIN = {"article", "main"}
AWAY = {"footer", "aside", "dialog", "noscript", "template"}
AROUND = {"nav", "header", "form", "menu", "fieldset", "search"}  # may stand open around an article, by mistake or by design
# Words in class and id names, and roles, of elements that aren't the article.
AWAY_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promoted promotion "
    "comment comments commentlist reply replies respond disqus discussion feedback "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall "
    "subscribe subscription newsletter signup login register search "
    "share sharing social related recommended recommendations trending popular "
    "sidebar side aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar toc "
    "footer foot header masthead topbar copyright legal disclaimer byline tags form hidden".split()
)
# Those of the words that also name page layouts around an article (a page "with sidebar").
LAYOUT_WORDS = frozenset("sidebar side aside widget widgets header masthead footer foot nav navbar menu toolbar topbar share sharing social search tags form promo promoted popular related hidden".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split())

TAG = re.compile(r"(/?)([a-zA-Z][^\s/><]*)")
STOP = re.compile(r"[<>]|=\s*[\"']")
ATTRIBUTES = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Characters of a tag's attributes up to which what they say is remembered.
KEPT_ATTRIBUTES = 200

FEATURES = ("words", "links", "before", "links_before", "after", "links_after", "main", "away", "heading", "rest")
# The labelled table: a page a string, a line begins with + where its blocks belong to the text and with - where they
# don't. {n} stands for n words, {an} for a link of n words.
LABELLED = [
    # pages that mark their article
    """-<header><a href=/>{2}</a></header><nav><ul><li>{a1}</li><li>{a1}</li><li>{a2}</li></ul></nav>
    -<div class=ad>{12}</div>
    +<article><h1>{7}</h1><p>{3}<br>{1}<p>{60}</p><p>{45} {a2} {20}</p><h2>{3}</h2><p>{90}</p><ul><li>{4}</li><li>{1}</li></ul></article>
    -<footer>{6}</footer>""",
    """-<nav>{a1} {a1} {a1}</nav><aside><p>{25}</p><ul><li>{a4}</li></ul></aside>
    +<main><h1>{5}</h1><p>{1}</p><p>{a3}</p><p>{12}</p><blockquote>{30}</blockquote><p>{2}</p></main>
    -<div class="related"><h3>{2}</h3><ul><li>{a6}</li><li>{a7}</li></ul></div><footer><p>{14}</p><p>{a1} {a1}</p></footer>""",
    """-<div class="cookie-notice"><p>{22}</p></div><header><h1>{a3}</h1><p>{6}</p></header>
    +<article class="post"><h2>{9}</h2><p>{70}</p><p>{50}</p><figure><figcaption>{6}</figcaption></figure><p>{8}</p>
    -<section class="comments"><h3>{2}</h3><div><p>{40}</p></div><div><p>{85}</p></div><div><p>{3}</p></div></section>
    +</article>
    -<div id=sidebar><h4>{2}</h4><p>{30}</p></div><footer>{9}</footer>""",
    """-<div id="top-banner">{9}</div><nav><ul><li>{a2}</li><li>{a2}</li></ul></nav>
    +<div class="page with-sidebar"><article><h1>{2}</h1><p>{400}</p><table><tr><td>{1}</td><td>{2}</td></tr><tr><td>{3}</td><td>{1}</td></tr></table></article>
    -<div class="widget"><p>{18}</p></div></div>
    -<div class=comments><article><p>{35}</p></article><article><p>{52}</p></article></div><footer>{5}</footer>""",
    """-<div role="navigation">{a1} {a1}</div><form action=/s><label>{2}</label><p>{4}</p></form>
    +<main><article><p>{15}</p><p>{a9}</p><ol><li>{20} {a2}</li><li>{a3}</li></ol><p>{1}</p></article>
    -<form><p>{6}</p><p>{18}</p></form>
    -<div class="share-buttons">{a1} {a1} {a1}</div></main>
    -<div class="newsletter"><p>{16}</p></div><footer>{20}</footer>""",
    """-<nav><ul><li>{a1}</li><li>{a1}</li><li>{a1}</li><li>{a1}</li></ul></nav><div class="ad">{5}</div>
    +<article><h1>{10}</h1><p>{10}<br><p>{150}</p><p>{14}<br><p>{33}</p></article>
    -<div><p>{30}</p></div><footer>{7}</footer>""",
    """-<header><p>{8}</p></header>
    +<article><header><h1>{6}</h1></header><p>{1}</p><p>{1}</p></article>
    -<aside>{50}</aside><section id="disqus_thread"><p>{28}</p><p>{75}</p></section>""",
    # pages that mark none: blocks of running text among lists of links and single lines
    """-<ul><li>{a1}</li><li>{a2}</li><li>{a1}</li><li>{a2}</li></ul>
    +<div><h1>{7}</h1><p>{60}</p><p>{25} {a2} {20}</p><p>{4}</p><p>{70}</p><p>{35}</p></div>
    -<ul><li>{a5}</li><li>{a6}</li><li>{a4}</li></ul><div>{a1} {a1} {2}</div>""",
    """-<table><tr><td>{a1}</td><td>{a1}</td><td>{a1}</td></tr></table>
    +<div><h2>{5}</h2><div>{80}</div><div>{2}</div><div>{55} {a3} {12}</div><div>{40}</div></div>
    -<div>{a2} {1} {a2} {1} {a2}</div><div><b>{2}</b></div><div>{a4}</div><div>{a5}</div>""",
    """+<p>{12}</p><p>{9}</p><p>{3}</p>""",
    """+<p>{200}</p>""",
    """+<div>{5}</div><div>{6}</div>""",
    """-<div>{a2} {a2} {a2} {a2}</div>
    +<h1>{4}</h1><p>{18}</p><p>{22}</p><h3>{3}</h3><p>{30}</p><p>{1}</p><p>{44}</p>
    -<h4>{2}</h4><ul><li>{a3}</li><li>{a7}</li></ul><p>{a1} {1} {a1}</p>""",
    """-<div>{a1}</div><div>{a1}</div><div>{a3}</div><div>{a8} {2}</div>
    +<div>{120}</div><div>{a2} {30}</div><div>{15}</div><div>{60}</div>
    -<div>{a6} {3}</div><div>{a5} {2}</div><div>{a1}</div>""",
    """-<div class="nav">{a1} {a1} {a1}</div>
    +<div class="text"><h1>{5}</h1><p>{45}</p><p>{3}</p><p>{65}</p></div>
    -<div class="reply"><p>{40}</p></div><div class="reply"><p>{20}</p></div><div class="footer">{8}</div>""",
    """-<div class="popup">{15}</div><ul><li>{a2}</li><li>{a3}</li></ul>
    +<h2>{6}</h2><ul><li>{14}</li><li>{9}</li><li>{17} {a2}</li></ul><p>{28}</p><pre>{40}</pre>
    -<div class="copyright">{10}</div>""",
    """-<ul><li>{a1}</li><li>{a1}</li></ul>
    +<div><p>{35}</p><p>{6}</p><p>{11}</p><p>{5}</p><p>{38}</p></div>
    -<ul><li>{a2}</li><li>{a2}</li></ul>""",
    # pages whose marks mislead: forms around everything, names that say something else, menus left open
    """+<form id=aspnetForm action=/x>
    -<div class=top><a href=/>{1}</a> {a1} {a1} {a2}</div>
    +<div><h1>{6}</h1><p>{50}</p><p>{3}</p><p>{40}</p><p>{8}</p></div>
    -<div class="footer">{7}</div></form>""",
    """+<form><table><tr><td>
    -<ul><li>{a1}</li><li>{a2}</li></ul>
    +</td><td><h2>{5}</h2><p>{90}</p><p>{14}</p></td></tr></table></form>""",
    """-<div>{a1} {a1} {a2}</div>
    +<div class="legal-advice"><h1>{5}</h1><p>{70}</p><p>{9}</p><p>{35}</p></div>
    -<div class=foot>{a2} {4}</div>""",
    """-<nav>{a1} {a2}</nav>
    +<main><h1>{8}</h1><section id=discussion><p>{60}</p><p>{5}</p><p>{55}</p></section></main>
    -<footer>{9}</footer>""",
    """-<ul class=menu><li>{a1}</li><li>{a1}</li></ul>
    +<div class="register-of-ships"><p>{44}</p><p>{61}</p><h3>{2}</h3><p>{12}</p></div>
    -<div class="ad">{11}</div>""",
    """-<nav><a href=/>{1}</a> {a2}
    +<article><h1>{4}</h1><p>{66}</p><p>{31}</p></article>
    -<footer>{6}</footer>""",
    # short articles with more in their comments than in them, marked and unmarked
    """-<header>{a2}</header>
    +<article><h1>{5}</h1><p>{30}</p><p>{25}</p></article>
    -<div class=comments><p>{60}</p><p>{85}</p><p>{40}</p></div><footer>{4}</footer>""",
    """-<div>{a1} {a2}</div>
    +<div class=story><h1>{5}</h1><p>{40}</p><p>{28}</p></div>
    -<div class="comment-list"><div class=comment><p>{50}</p></div><div class=comment><p>{70}</p></div></div><div class=footer>{a1} {3}</div>""",
    """-<nav>{a1} {a1}</nav>
    +<article><h1>{6}</h1><p>{80}</p><p>{22}</p></article>
    -<div class=msg><p>{31}</p></div><div class=msg><p>{12}</p></div><div class=msg><p>{44}</p></div>""",
    """-<div>{a1} {a2} {a1}</div><h3>{a4}</h3><p>{9} {a2}</p><h3>{a5}</h3><p>{10} {a2}</p><h3>{a6}</h3><p>{8} {a2}</p><div>{a1} {a1}</div>""",
]
WORDS = re.compile(r"\{(a?)(\d+)\}")


def labelled(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages."""
    x, y = [], []
    for page in pages:
        said, place, marks = "", [], []
        for line in (s.strip() for s in page.split("\n")):
            place.append(len(said))
            marks.append(line[0] == "+")
            said += WORDS.sub(lambda m: f"<a href=x>{'w ' * int(m[2])}</a>" if m[1] else "w " * int(m[2]), line[1:])
        found = blocks(said)
        x.append(features(found))
        y += [marks[int(np.searchsorted(place, f[5], "right")) - 1] for f in found]
    return np.concatenate(x), np.array(y, np.float64)


class DecisionTree:
    """Binary splits that lower the Gini impurity most, grown until leaves are pure or would have fewer than ``least``
    rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, least: int = 2):
        self.least = least
        self.nodes: list[tuple[int, float, int, int]] = []  # feature (-1: leaf), bound (leaf: class), where <=, where >
        self._grow(x, y)

    def _grow(self, x: np.ndarray, y: np.ndarray) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, float(y.mean() >= 0.5), -1, -1))
        if 0 < y.mean() < 1:
            best = None
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for bound in (values[:-1] + values[1:]) / 2:
                    left = x[:, f] <= bound
                    if min(left.sum(), (~left).sum()) < self.least:
                        continue
                    cost = sum(len(s) * s.mean() * (1 - s.mean()) for s in (y[left], y[~left]))
                    if best is None or cost < best[0] - 1e-12:
                        best = cost, f, float(bound)
            if best:
                _, f, bound = best
                left = x[:, f] <= bound
                self.nodes[me] = (f, bound, self._grow(x[left], y[left]), self._grow(x[~left], y[~left]))
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        feature, bound, low, high = (np.array(c) for c in zip(*self.nodes))
        rows = np.arange(len(x))
        while (inner := feature[at] >= 0).any():
            r, n = rows[inner], at[inner]
            at[inner] = np.where(x[r, feature[n]] <= bound[n], low[n], high[n])
        return bound[at] > 0.5


@lru_cache(maxsize=1)
def trained() -> DecisionTree:
    return DecisionTree(*labelled(LABELLED))


@lru_cache(maxsize=4096)
def _away(tag: str, attributes: str) -> int:
    """2 where the tag, its role or a word of its class and id says that what is inside isn't the article, 1 where that may
    stand around one, else 0."""
    if tag in AWAY:
        return 2
    around = int(tag in AROUND)
    words: set[str] = set()
    for name, value in ATTRIBUTES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return 2
        if name == "role" and value.lower() in AWAY_ROLES:
            return 2
        if name in ("class", "id"):
            words |= AWAY_WORDS & {w.lower() for w in NAME_WORDS.findall(value)}
    return around if not words else 1 if words <= LAYOUT_WORDS else 2


def decoded(text: str) -> str:
    """Character references decoded, once."""
    if "&" not in text:
        return text
    return "&".join(html.unescape(part) if "&" in part else part for part in text.split("&amp;"))


class Places:
    """Where something occurs next. Asked for places that don't go back, all answers together read a page once."""

    def __init__(self, page: str):
        self.page, self.known = page, {}

    def after(self, what: str | re.Pattern, at: int) -> tuple[int, int]:
        """Start and end of the next ``what`` from ``at`` on; (-1, -1) where there is none."""
        found = self.known.get(what, (-2, -2))
        if found[0] == -1 or found[0] >= at:
            return found
        if isinstance(what, str):
            start = self.page.find(what, at)
            found = (start, start + len(what) if start >= 0 else -1)
        else:
            m = what.search(self.page, at)
            found = m.span() if m else (-1, -1)
        self.known[what] = found
        return found


@lru_cache(maxsize=64)
def _same(tag: str) -> re.Pattern:
    return re.compile(rf"</?{re.escape(tag)}(?![^\s/>])", re.I)


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?![^\s/>])[^>]*>?", re.I)


def _tag_end(page: str, at: int, places: Places) -> tuple[int, int]:
    """Where the attributes from ``at`` on end, and where the tag does: at its ``>`` outside of quoted values, or before
    the next ``<``. Without either it is over at once."""
    begin = at
    while m := STOP.search(page, at):
        if (c := page[m.start()]) != "=":
            return m.start(), m.end() if c == ">" else m.start()
        close = places.after(page[m.end() - 1], m.end())[0]
        at = m.end() if close < 0 else close + 1
    return begin, begin


def blocks(page: str) -> list[tuple[str, float, int, float, int, int]]:
    """(text, share of linked words, main, away, heading, where it begins) of each text block, in page order; main: 1
    inside, else 0; away: 0 where nothing around it says that it isn't the article, else how few unlinked words the innermost
    element that says so holds, beside the largest of them and beside all words that nothing is said of: near 0 to 1."""
    found, parents = _blocks(page)
    # unlinked words of each marked element, with those of the ones inside it, which come later
    held, rest = [0.0] * len(parents), 0.0
    for f in found:
        n = (f[0].count(" ") + 1) * (1 - f[1])
        if f[3] >= 0:
            held[f[3]] += n
        else:
            rest += n
    for k in range(len(parents) - 1, -1, -1):
        if parents[k] >= 0:
            held[parents[k]] += held[k]
    most = max(held, default=0.0)
    return [(*f[:3], max(1e-3, 1 - held[f[3]] / max(rest + held[f[3]], most, 1e-9)) if f[3] >= 0 else 0.0, *f[4:]) for f in found]


def _blocks(page: str) -> tuple[list[tuple[str, float, int, int, int, int]], list[int]]:
    """The blocks, with the number of the innermost marked element (-1: none) in place of ``away``; and of each marked element
    the one around it."""
    out: list[tuple[str, float, int, int, int, int]] = []
    stack: list[tuple[str, bool, int, int]] = [("", False, 0, -1)]  # tag, in an article, away, innermost marked element
    opened: dict[str, list[int]] = {}  # places in the stack, by tag
    parents: list[int] = []
    parts: list[str] = []
    linked: list[str] = []
    places = Places(page)
    in_link, lost, heading, at, begin, size = False, False, 0, 0, 0, len(page)

    def flush() -> None:
        if parts:
            words = decoded("".join(parts)).split()
            if words:
                share = min(1.0, len(decoded(" ".join(linked)).split()) / len(words)) if linked else 0.0
                _, main, _, mark = stack[-1]
                out.append((" ".join(words), share, int(main), mark, heading, begin))
            parts.clear()
            linked.clear()

    def close(k: int) -> None:
        while len(stack) > k:
            opened[stack.pop()[0]].pop()

    def say(start: int, end: int) -> None:
        nonlocal begin
        if end > start and not lost:
            if not parts:
                begin = start
            parts.append(page[start:end])
            if in_link:
                linked.append(page[start:end])

    while at < size:
        start = page.find("<", at)
        if start < 0:
            say(at, size)
            break
        say(at, start)
        m = TAG.match(page, start + 1)
        if not m:
            after = page[start + 1 : start + 2]
            if after not in ("!", "?", "/"):
                say(start, start + 1)
                at = start + 1
                continue
            what = "-->" if page.startswith("<!--", start) else "]]>" if page.startswith("<![CDATA[", start) else ">"
            end = places.after(what, start + 2)[1]
            if end < 0:
                end = places.after(">", start + 2)[1]
            at = end if end >= 0 else start + 2
            continue
        lost = False
        tag = m[2].lower()
        stop, at = _tag_end(page, m.end(), places)
        attributes = page[m.end() : stop]
        if m[1]:
            if tag == "a":
                in_link = False
            elif tag in CONTAINERS or tag in LEAVES:
                flush()
                heading = 0
                if tag in LEAVES:
                    if stack[-1][0] == tag:
                        close(len(stack) - 1)
                else:
                    in_link = False
                    if opened.get(tag):
                        close(opened[tag][-1])
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                end = places.after(_end_of(tag), at)[1]
                lost, at = end < 0, max(at, end)
        elif tag in CONTROLS:
            found = places.after(_same(tag), at)
            if found[0] >= 0 and page[found[0] + 1] == "/":
                at = found[0]
        elif tag == "a":
            in_link = True
        elif tag in BREAKS:
            flush()
        elif tag in CONTAINERS or tag in LEAVES:
            flush()
            while stack[-1][0] in LEAVES and not (tag in CONTAINERS and stack[-1][0] in ("li", "dd", "td", "th")):
                close(len(stack) - 1)
            if tag in ("td", "th", "li", "dt", "dd") and stack[-1][0] == tag:
                close(len(stack) - 1)
            _, main, away, mark = stack[-1]
            heading = int(tag in LEAVES and tag[0] == "h" and tag != "th")
            if tag in MAIN and away == 1:
                away, mark = 0, -1  # it was the layout around the article
            main = main or tag in MAIN
            judge = _away if len(attributes) <= KEPT_ATTRIBUTES else _away.__wrapped__
            own = 0 if tag in ("html", "body", "main") or tag == "header" and main else judge(tag, attributes)
            if own:
                parents.append(mark)
                mark = len(parents) - 1
            opened.setdefault(tag, []).append(len(stack))
            stack.append((tag, main, max(away, own), mark))
    flush()
    return out, parents


def features(found: list[tuple[str, float, int, float, int, int]]) -> np.ndarray:
    """``FEATURES`` of each block of a page; ``rest`` is the page's share of running text that nothing marks."""
    x = np.zeros((len(found), len(FEATURES)))
    if found:
        x[:, 0] = [f[0].count(" ") + 1 for f in found]
        x[:, 1] = [f[1] for f in found]
        x[:, 2], x[:, 4] = -1, -1
        x[1:, 2:4], x[:-1, 4:6] = x[:-1, :2], x[1:, :2]
        main = np.array([f[2] for f in found])
        x[:, 6] = np.where(main > 0, 1, -1) if (main * [f[3] == 0 for f in found]).any() else 0
        x[:, 7], x[:, 8] = [f[3] for f in found], [f[4] for f in found]
        running = x[:, 0] * (1 - x[:, 1])
        x[:, 9] = running[x[:, 7] == 0].sum() / max(1.0, running.sum())
    return x


def main_text(pages: list[str | None], tree: DecisionTree | None = None) -> list[str]:
    """The text of each page: the blocks that the tree takes for the article, joined by one space."""
    found = [blocks(p) if p else [] for p in pages]
    flat = [features(f) for f in found if f]
    keep = (tree or trained()).predict(np.concatenate(flat)).tolist() if flat else []
    out, at = [], 0
    for f in found:
        out.append(" ".join(b[0] for b, k in zip(f, keep[at : at + len(f)]) if k))
        at += len(f)
    return out


def extract(pages: DataFrame, markup: str = "html") -> DataFrame:
    """``pages`` without ``markup``, with ``text`` and ``n_chars`` (code points) after its columns.

    A null or empty page, and one without article text, has an empty text. Pages are read whole, at any length, in time
    that grows with it, in slices of a few; equal rows give equal results, an empty table gives an empty one. Columns of ``pages`` named ``text`` or ``n_chars`` are replaced,
    others pass through.
    """

    def start():
        def run(pages: pa.Array) -> list:
            said = main_text(pages.to_pylist())
            return [pa.array(said, pa.string()), pa.array([len(s) for s in said], pa.int64())]

        return run

    return Packed(pages, markup, {"text": T.StringType(), "n_chars": T.LongType()}, keep_text=False).mapped(start)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spread(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
