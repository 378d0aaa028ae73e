"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags.  Words score positive and tags
negative; a linear scan finds the contiguous stretch of the highest sum, the
content region.  How much a kind of word or tag weighs is learnt from labelled
pages, those that mark their article themselves: kinds that lie outside more
often weigh against a region, links and boilerplate containers among them; links
of headings and of a page's own marked article don't.
Within the region the text of blocks is taken, without what is no article by
its element or by its container's name.

Null and empty pages, and pages without words, give an empty text.  Unclosed
and stray tags are allowed; character references are decoded; white space
within a block becomes one space; blocks are joined by a newline.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample

#: Labelled pages that weights are learnt from, about.
LABELLED = 400
#: Code points of the longest of them.
LONGEST = 100_000

# Element names of HTML by what they mean here.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
OUTSIDE = {"nav", "footer", "aside", "form", "button", "select", "option", "noscript", "template", "svg", "canvas", "object", "dialog", "menu", "head", "datalist", "audio", "video", "map"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in a container's class, id, role or label that say what it is.
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "alert", "popup", "modal", "overlay", "sidebar", "side", "rail", "widget", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar",
    "footer", "foot", "masthead", "comment", "comments", "disqus", "replies", "reply", "respond", "discussion", "share", "sharing", "social", "related", "recommended", "recommendations",
    "newsletter", "subscribe", "subscription", "signup", "login", "search", "skip", "complementary", "contentinfo", "toc", "hidden", "copyright",
}
#: Those that say it inside an article or main part too, what may stand beside them there, and what turns them round ("no-sidebar").
SURE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsored", "cookie", "cookies", "gdpr", "sidebar", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination",
    "comments", "disqus", "newsletter", "complementary", "contentinfo",
}
BESIDE = {"area", "articles", "bar", "block", "body", "box", "container", "content", "form", "inner", "item", "items", "links", "list", "panel", "posts", "section", "slot", "stories", "thread", "unit", "wrap", "wrapper"}
TURNED = {"free", "has", "hide", "no", "non", "with", "without"}
#: Those that say it of a container as its whole name, beside such words or others that say it ("comment-list", "notice").
WHOLE = SURE | {"comment", "notice", "notices", "related", "recommended", "share", "sharing", "social", "promo", "banner", "subscribe", "subscription", "alert"}
#: Those that say it as a name's last word where no article or main part is marked ("top-menu").
LAST = SURE | {"ad", "menu", "nav", "footer", "masthead", "banner", "popup", "modal", "widget", "toolbar", "consent", "notice", "login", "signup", "pager"}
#: Elements that hold others; and those of text, whose names are never a verdict.
CONTAINERS = {"center", "details", "div", "dl", "fieldset", "ol", "section", "table", "ul"}
TEXTUAL = {"b", "blockquote", "caption", "code", "dd", "dt", "em", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "i", "li", "p", "pre", "strong", "td", "th", "tr"}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)|[^<]+|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+|[0-9]+", re.I)
_RAW_END = {x: re.compile(f"</{x}", re.I) for x in RAW}


def surely(parts: list[str], last: bool) -> bool:
    """Whether the words of a name are boilerplate's in an article too; last: its last word may say so alone ("story-advert")."""
    if not parts or parts[0] in TURNED:
        return False
    return last and parts[-1] in SURE or not WHOLE.isdisjoint(parts) and all(x in WHOLE or x in NAMES or x in BESIDE for x in parts)


def named(parts: list[str]) -> bool:
    """Whether a name says boilerplate where no article is marked: by its last word, or if it has no word that says anything else."""
    if not parts or parts[0] in TURNED:
        return False
    return parts[-1] in LAST or not NAMES.isdisjoint(parts) and all(x in NAMES or x in BESIDE for x in parts)


def boilerplate(tag: str, name: str, titled: bool, art: int = 0) -> bool:
    """Whether an element is none of the article by what it is or is called; titled: it is a header in an article with the main heading.

    Names of text elements and ids of sections, which are slugs of headings,
    say nothing.  In an article or main part (art) only unambiguous names of
    containers count, an id's if it is of several words; a class of an article
    tells a reader's comment from the page's own.
    """
    if name in OUTSIDE or name in RAW or name == "header" and not titled:
        return True
    if "=" not in tag and "hidden" not in tag:
        return False
    if name in ("html", "body", "main"):
        return False
    marks = {}
    for key, *values in _ATTRIBUTE.findall(tag, 1 + len(name)):
        marks.setdefault(key.lower(), "".join(values).lower())
    if "hidden" in marks or marks.get("aria-hidden") == "true" or _NONE.search(marks.get("style", "")):
        return True
    split = lambda x: [y for y in _PARTS.findall(x) if not y.isdigit()]
    if name == "article":
        return any(surely(split(word), False) for word in marks.get("class", "").split())
    if name in TEXTUAL or art and name not in CONTAINERS:
        return False
    slug = name == "section" or "section" in marks.get("class", "").split()
    for key in ("class", "role", "id", "aria-label"):
        if key == "id" and slug:
            continue
        for word in marks.get(key, "").split() if key != "aria-label" or not art else [marks.get(key, "")]:
            parts = split(word)
            if art:
                if (key != "id" or len(parts) > 1) and surely(parts, key in ("class", "role")):
                    return True
            elif named(parts):
                return True
    return False


def events(html: str) -> Iterator[tuple[str, str, bool, int]]:
    """(kind, text or tag name, in boilerplate, 2 in an article, 1 in a main element) of a page's text runs and tags, in order.

    kind is "text", "open" or "close".  Elements that a closing tag leaves open
    inside it end with it; a new paragraph ends an open one.
    """
    stack: list[tuple[str, bool, bool]] = []
    places: dict[str, list[int]] = defaultdict(list)  # of the open elements by name
    blocks: list[int] = []  # places of the open blocks
    bad = articles = mains = art = 0

    def pop(to: int):
        nonlocal bad, articles, mains, art
        while len(stack) > to:
            name, was, counted = stack.pop()
            places[name].pop()
            if name in BLOCKS:
                blocks.pop()
            bad -= was
            articles -= counted and name == "article"
            mains -= counted and name == "main"
        art = 2 if articles else 1 if mains else 0

    marks: list[list[int]] = []  # where headers end and main headings begin, found once if a header asks

    def has_heading(at: int) -> bool:
        if not marks:
            marks.extend([m.start() for m in re.finditer(x, html, re.I)] for x in ("</header", "<h1"))
        end, first = bisect_left(marks[0], at), bisect_left(marks[1], at)
        return first < len(marks[1]) and (end == len(marks[0]) or marks[1][first] < marks[0][end])

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.match(html, at)
        at, t = m.end(), m.group()
        if t[0] != "<" or t == "<":
            yield "text", t, bad > 0, art
            continue
        if t.startswith("<![CDATA["):
            continue
        found = _NAME.match(t)
        if not found:
            continue  # comment, doctype, processing instruction
        name = found.group(1).lower()
        if t[1] == "/":
            if places[name] and (name in BLOCKS or not blocks or blocks[-1] < places[name][-1]):
                inside = bad > 0
                pop(places[name][-1])
                yield "close", name, inside, art
            continue
        if blocks and (name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or name in BLOCKS):
            # what a new block of this kind ends: an open paragraph, or its like
            ended = {name} if name in ("li", "dt", "dd", "tr", "td", "th", "option") else set()
            if stack[blocks[-1]][0] in ended | {"p"}:
                pop(blocks[-1])
        if name in VOID or t.endswith("/>"):
            yield "open", name, bad > 0, art
            continue
        outside = boilerplate(t, name, name == "header" and art > 0 and has_heading(at), art)
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            raw = html[at : end.start()] if end else html[at:]
            yield "open", name, True, art
            if raw:
                yield "text", raw, True, art
            yield "close", name, True, art
            at = (html.find(">", end.start()) + 1 or n) if end else n
            continue
        places[name].append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        bad += outside
        stack.append((name, outside, bad == 0))
        articles += bad == 0 and name == "article"  # a reader's comment is none
        mains += bad == 0 and name == "main"
        art = 2 if articles else 1 if mains else 0
        yield "open", name, bad > 0, art


def kinds(seq: list) -> list[str]:
    """The kind of each event: words by where they are, tags by their name and whether they are in boilerplate.

    On a page that marks an article (or else a main part), words beside it are a kind of their own.
    """
    most = max((art for *_, art in seq), default=0)
    out, links = [], 0
    for kind, x, bad, art in seq:
        if kind == "text":
            out.append("word outside" if bad else "word beside" if art < most else "word linked" if links > 0 else "word")
        else:
            links += (x == "a") * (1 if kind == "open" else -1)
            out.append("tag outside" if bad else ("-" if kind == "close" else "+") + x)
    return out


def learn_weights(pages: list[str]) -> dict[str, float]:
    """Weights of words and tags from pages that mark their article: logarithms of how much likelier a kind is inside.

    A plain word weighs one at least; no tag weighs more than a slight loss.
    """
    inside, outside = Counter(), Counter()
    for p in pages:
        seq = list(events(p))
        for kind, (what, x, _, art) in zip(kinds(seq), seq):
            (inside if art == 2 else outside)[kind] += len(x.split()) if what == "text" else 1
    weights = {}
    for kind in {*inside, *outside, "word", "word linked", "word beside", "word outside", "tag outside"}:
        odds = math.log((inside[kind] + 1) / (outside[kind] + 1))
        low, high = (1.0, 3.0) if kind == "word" else BOUNDS.get(kind, (-3.0, -0.05))
        weights[kind] = min(high, max(low, odds))
    return weights


#: What is left out by its container weighs little, so that an aside doesn't part an article.
BOUNDS = {"word outside": (-0.1, -0.05), "tag outside": (-0.1, -0.05), "word linked": (-0.5, 0.5), "word beside": (-2.0, -0.5)}
#: Weight of a tag that no labelled page has.
UNSEEN = -0.2


#: Least weight of a linked word that is the page's own: of a heading or of its marked article.
OWN = 1.0


def own_links(seq: list) -> list[bool]:
    """Whether each event is of the page's own article, or a link's in or around a heading."""
    out, headed, titled, links = [], False, False, 0
    for kind, x, bad, art in seq:
        if kind != "text":
            if x in BLOCKS:
                headed = kind == "open" and x in HEADINGS
            links += (x == "a") * (1 if kind == "open" else -1)
            titled = headed and links > 0 or titled and not (x == "a" and kind == "open")
        out.append(not bad and (art == 2 or headed and (kind == "text" or x == "a") or titled and kind == "close" and x == "a"))
    return out


def scored(seq: list, weights: dict[str, float]) -> list[float]:
    """The weight of each event; linked words of the page's own weigh as words whatever was learnt, and its tags lose no more than unseen ones."""
    out = []
    for kind, (what, x, *_), own in zip(kinds(seq), seq, own_links(seq)):
        w = weights[kind] if what == "text" else weights.get(kind, UNSEEN)
        if own and (what != "text" or kind == "word linked"):
            w = max(w, OWN if what == "text" else UNSEEN)
        out.append(len(x.split()) * w if what == "text" else w)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last + 1 of the contiguous stretch of the highest sum; (0, 0) if no score is positive.  Of equal sums the longer, then the first."""
    best, where = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or total == best > 0 and i + 1 - start > where[1] - where[0]:
            best, where = total, (start, i + 1)
    return where


def main_text(html: str | None, weights: dict[str, float]) -> str:
    if not html:
        return ""
    seq = list(events(html))
    first, last = best_region(scored(seq, weights))
    blocks: list[str] = []
    now: list[str] = []
    for kind, x, bad, _ in seq[first:last]:
        if kind == "text":
            if not bad:
                now.append(x)
        elif x in BLOCKS:
            blocks.append("".join(now))
            now = []
        elif x == "br":
            now.append(" ")
    blocks.append("".join(now))
    return "\n".join(filter(None, (" ".join(unescape(b).split()) for b in blocks)))


def _texts(weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            for at in range(0, max(1, b.num_rows), 256):
                part = b.slice(at, 256)
                out = pa.array([main_text(x, w) for x in part.column(part.num_columns - 1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], out], names=[*b.schema.names[:-1], "text"])

    return run


def extract_text(pages: DataFrame, key_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", labelled: int = LABELLED, longest: int = LONGEST) -> DataFrame:
    """key_cols and text, the main text of each whole page.

    Weights come from about `labelled` pages that mark exactly one article and
    have `longest` code points at most, those of the smallest hashes; the rest
    of the work covers all pages.
    """
    short = pages.select(F.col(html_col).alias("html")).where(F.char_length("html") <= longest)
    marked = short.where(F.regexp_count("html", F.lit("(?i)<article[ >]")) == 1).where("instr(html, '</article>') > 0")
    taken = [r.x for r in sorted(hash_sample(marked, "html", labelled).collect(), key=lambda r: r.h)]  # about `labelled` pages
    weights = pages.sparkSession.sparkContext.broadcast(learn_weights(taken))
    keys = pages.select(*key_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields), "text string"])
    return pages.select(*key_cols, F.col(html_col).alias("__html")).mapInArrow(_texts(weights), schema)
