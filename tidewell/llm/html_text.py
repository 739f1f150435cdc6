"""HTML extraction by the distribution of text over line blocks.

Markup is stripped: every block element starts a line. A line weighs as many characters
as stand outside links; marks change weights, and nothing else. What markup names as
beside the article (menus, headers, footers, asides, notices, adverts, forms, comments)
weighs nothing; lines in an article or main element weigh INSIDE times as much, and
those of the same page outside of it OUTSIDE times. The weights are summed over sliding
windows of BLOCK lines. A stretch of the page surges where a window's sum reaches SURGE
and dives where windows sum to nothing. From the surge point (taken back to a heading of
the stretch or on to its top heading, or to the border of an article) to the dive point its lines are kept, as
are shorter stretches between two that surge. If no window of the page surges, the
stretch that weighs most is kept.

A class, id or role is a word of the page's author and may be wrong: it counts for
nothing on an element that holds the page's only top heading, its main element or its
only articles, or without which no text of the page would surge.

Defined results: a null html is an empty page and gives an empty text, as does a page
without text. Rows stand alone: repeats and order do not matter. Further columns are
not read.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import common

QUERY = "op8_html_text"

#: Lines of a window, and the weighted characters in one that make a surge.
BLOCK, SURGE = 3, 80
#: Weights of lines inside and outside the articles that a page marks.
INSIDE, OUTSIDE = 4.0, 0.1

#: Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math object canvas select".split())
LINES = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr ul br".split()
)
OTHER = frozenset("nav header footer aside form menu dialog button fieldset search".split())
CLOSES_P = LINES - {"br", "body", "html", "option", "optgroup", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
#: What an element of the key ends, if open, up to the nearest of the elements after the bar.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    **{k: ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}) for k in ("tbody", "thead", "tfoot")},
}
INLINE = frozenset("a abbr b cite code em font i label mark s small span strong sub sup u".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id or role that name a part beside the article; those that begin such a word.
BESIDE = frozenset(
    "ad ads adv adsense adslot banner side rail header masthead topbar toolbar respond replies reply consent gdpr alert popup modal overlay newsletter subscribe signup login share sharing "
    "social related copyright pagination pager skip contentinfo complementary search dialog".split()
)
BESIDE_BEGIN = ("advert", "sponsor", "promo", "nav", "menu", "breadcrumb", "sidebar", "widget", "footer", "comment", "disqus", "notice", "cookie", "recommend")
#: Words that turn a name into a property of the page; words that make a header the article's own.
PROPERTY = frozenset("has no non not with without layout template enabled disabled".split())
OWN_HEADER, TOP = frozenset("entry article post story news blog content".split()), frozenset("header masthead topbar banner".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


@lru_cache(1 << 14)
def names_beside(value: str) -> str:
    """The first word of a class, id or role that names a part beside the article; '' if none does."""
    for name in value.split():
        parts = [x for x in re.split(r"[-_]+", name) if x]
        if PROPERTY.intersection(parts):
            continue
        own = OWN_HEADER.intersection(parts)
        for x in parts:
            if (x in BESIDE or x.startswith(BESIDE_BEGIN)) and not (own and x in TOP):
                return x
    return ""


def _marked(name: str, rest: str) -> tuple[bool, str, bool]:
    """Whether an element is beside the article by its kind, the word by which its author names it so, and whether it is hidden."""
    if name in OTHER:
        return True, "", False
    word = ""
    if "=" in rest or "hidden" in rest:
        for k, v in _ATTRIBUTE.findall(rest):
            k, v = k.lower(), html.unescape(v.strip("\"'")).lower()
            if k in ("class", "id", "role") and name not in ("body", "html", "main"):
                word = word or names_beside(v)
            if k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v):
                return False, "", True
    return False, word, False


class Line(NamedTuple):
    """A line's text, its characters outside links, the level of its heading (0: none), whether beside the article by markup, by which marks of the author, and the article it is in (0: none)."""

    text: str
    plain: int
    heading: int
    beside: bool
    marks: tuple[int, ...]
    article: int


class _Open(NamedTuple):
    name: str
    beside: bool
    marks: tuple[int, ...]
    article: int
    mute: bool


def lines_of(page: str) -> tuple[list[Line], list[dict]]:
    """Lines of a page, those without text standing for borders, and what each mark of its author holds."""
    lines: list[Line] = []
    words: list[tuple[str, bool]] = []
    stack: list[_Open] = []
    marks: list[dict] = []  # word, and whether it holds a top heading, a main element, an article
    now = ground = _Open("", False, (), 0, False)
    articles, linked = 0, False
    at, end = 0, len(page)

    def put(text: str) -> None:
        if not now.mute:
            words.append((text, linked))

    def close_line() -> None:
        nonlocal linked
        if words:
            text = " ".join(html.unescape("".join(w for w, _ in words)).split())
            if text:
                inside = sum(len(html.unescape(w).strip()) for w, of_link in words if of_link)
                heading = min((int(x.name[1]) for x in stack if x.name in HEADINGS), default=0)
                lines.append(Line(text, max(0, len(text) - inside), heading, now.beside, now.marks, now.article))
            words.clear()
        linked = False

    def border(of: _Open) -> None:
        lines.extend([Line("", 0, False, of.beside, of.marks, 0)] * BLOCK)

    def leave(to: int) -> None:
        nonlocal now
        close_line()
        was, now = now, stack[to - 1] if to else ground
        del stack[to:]
        if not now.article and (was.beside != now.beside or was.marks != now.marks):
            border(was)
        elif was.article != now.article:
            border(ground)

    def find(names, until=frozenset()) -> int:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name in names:
                return k
            if stack[k].name in until:
                return -1
        return -1

    while at < end:
        opened = page.find("<", at)
        if opened < 0:
            put(page[at:])
            break
        if opened > at:
            put(page[at:opened])
        m = _TOKEN.match(page, opened)
        if not m:
            put("<")
            at = opened + 1
            continue
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name, rest = m[2].lower(), m[3] or ""
        if m[1]:
            if name == "a":
                linked = False
            if name in INLINE:
                if (k := find({name}, LINES)) >= 0:
                    del stack[k:]
                    now = stack[-1] if stack else ground
                continue
            if name == "p" and find({"p"}) < 0:
                close_line()
            elif name in LINES or name in OTHER or find({name}) >= 0:
                k = find({name}, frozenset() if name in ("body", "html", "article", "main") else {"article", "main", "body"} - {name})
                if name in LINES or name in OTHER:
                    close_line()
                if k >= 0:
                    leave(k)
            continue
        if name in RAW and not rest.rstrip().endswith("/"):
            shut = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if shut:
                at = shut.end()
            elif name in ("script", "style", "textarea", "title", "xmp", "iframe"):
                at = end
            if name in ("title", "script", "style"):
                continue
            if name not in ("svg", "math"):
                close_line()
            continue
        if name in LINES:
            close_line()
        if name in VOID:
            continue
        if name in CLOSES_P and (k := find({"p"}, {"td", "th", "button", "body"})) >= 0:
            leave(k)
        if name in ENDS:
            names, until = ENDS[name]
            k = find(names, until)
            if k >= 0:
                if name in ("tr", "tbody", "thead", "tfoot"):
                    while (up := find(names, until)) >= 0:
                        leave(up)
                else:
                    leave(k)
        if name == "a":
            linked = True
        beside, word, hidden = _marked(name, rest)
        if now.article and (name == "header" or word in TOP):  # the article's own header
            beside, word = False, ""
        holds = {"h1": "heading", "main": "main", "article": "article"}.get(name)
        if holds and not beside and not word and not now.beside:
            for k in now.marks:
                marks[k][holds] = True
        if name in INLINE:  # inside a line: left out of it
            if word or hidden or now.mute:
                now = now._replace(name=name, mute=True)
                stack.append(now)
            continue
        new = now._replace(name=name, beside=now.beside or beside, mute=now.mute or hidden)
        if word and not new.beside:
            marks.append({"word": word})
            new = new._replace(marks=(*now.marks, len(marks) - 1))
        if name in ("article", "main") and not new.beside and not word and not now.article:
            articles += 1
            new = new._replace(article=articles)
        changed = new._replace(name=now.name) != now
        if changed:
            close_line()
            if not now.article and (new.article or new.beside != now.beside or new.marks != now.marks):
                border(ground if new.article else new)
        if name in LINES or name in OTHER or changed:
            stack.append(new)
            now = new
    close_line()
    return lines, marks


def window_sums(weights: list[float], block: int = BLOCK) -> list[float]:
    """The weight of the window that starts at each line."""
    return [sum(weights[i : i + block]) for i in range(len(weights))]


def stretches(weights: list[float], block: int = BLOCK, surge: float = SURGE) -> list[tuple[int, int]]:
    """Stretches to keep: lines [from, to) whose windows sum to more than nothing, one of them to a surge; shorter ones between two such; the weightiest if none surges."""
    n = len(weights)
    sums = window_sums(weights, block)
    found, i = [], 0
    while i < n:
        if sums[i] <= 0:
            i += 1
            continue
        k = i
        while k < n and sums[k] > 0:
            k += 1
        found.append((i, k, max(sums[i:k]), sum(weights[i:k])))
        i = k
    high = [k for k, f in enumerate(found) if f[2] >= surge]
    if high:
        return [f[:2] for f in found[high[0] : high[-1] + 1]]
    return [max(found, key=lambda f: (f[3], -f[0]))[:2]] if found else []


def _kept(lines: list[Line], void: set[int]) -> tuple[list[Line], bool]:
    """The lines to keep, without the marks in void, and whether a window surged."""
    shown, weights = [], []
    of_article = any(x.article and x.text and not x.beside and not set(x.marks) - void for x in lines)
    for x in lines:
        beside = x.beside or bool(set(x.marks) - void)
        if not x.text and x.marks and not x.beside and not beside:
            continue  # the border of a mark that does not count
        if beside and x.article:
            continue  # what stands beside an article inside of it does not part it
        shown.append((x, beside))
        # A letter of a link counts a thousandth, so that a page of links alone has a stretch.
        weigh = (x.plain + len(x.text) / 1000) * (INSIDE if x.article else OUTSIDE if of_article else 1.0)
        weights.append(0.0 if beside or not x.text or not x.plain and not x.heading and not x.article else weigh)
    if not any(weights):
        weights = [0.0 if beside else float(len(x.text)) for x, beside in shown]
    out, sums = [], window_sums(weights)
    for first, dive in stretches(weights):
        span = [k for k in range(first, dive) if shown[k][0].text and not shown[k][1]]
        if not span:
            continue
        if not shown[span[-1]][0].article:
            risen = next((k for k in range(first, dive) if sums[k] >= SURGE), first)
            risen = next((k for k in range(risen, dive) if weights[k]), first)
            # The surge point goes back to the stretch's first heading or on to the page's; no links stand alone at the ends.
            top = [k for k in span if shown[k][0].heading == 1 and k < risen + BLOCK]
            risen = top[0] if top else min([risen, *(k for k in span if shown[k][0].heading)])
            span = [k for k in span if k >= risen]
            while span and not weights[span[0]]:
                span.pop(0)
            while span and not weights[span[-1]]:
                span.pop()
        out += [shown[k][0] for k in span]
    return out, max(sums, default=0.0) >= SURGE


def main_text(page: str | None) -> str:
    """The article's lines, joined by line feeds."""
    if not page:
        return ""
    lines, marks = lines_of(page)
    if not any(x.text for x in lines):
        return ""
    # Marks that can't be meant: they hold what the page has only once.
    void = set()
    for holds in ("heading", "main", "article"):
        free = any((x.heading == 1 if holds == "heading" else x.article) and x.text and not x.beside and not x.marks for x in lines)
        if not free:
            void |= {k for k, m in enumerate(marks) if m.get(holds) and not m["word"].startswith("comment") and not (holds == "heading" and m["word"] in TOP)}
    kept, surged = _kept(lines, void)
    if not surged and len(void) < len(marks):
        # No text surges without the marked parts: those that hold half of the page's are no parts beside it.
        size = [0] * len(marks)
        for x in lines:
            for k in x.marks:
                size[k] += 0 if x.beside else x.plain
        large = {k for k, n in enumerate(size) if 2 * n > sum(x.plain for x in lines if not x.beside) and not marks[k]["word"].startswith("comment")}
        if not large <= void and (more := _kept(lines, void | large))[1]:
            kept = more[0]
    return "\n".join(x.text for x in kept)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keep columns and text, the main text of every whole html."""
    common.bound_batches(pages.sparkSession)
    source = pages.select(*keep, F.col("html").alias("__html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    return source.mapInArrow(run, source.select(*keep).schema.add("text", "string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(common.read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
