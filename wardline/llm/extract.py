"""HTML extraction (operator 7): line-block distribution.

Markup is stripped to lines, one per block element, in page order.  Elements
that cannot hold article text (menus, page headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments) become runs of blank lines.  A class
name or id says so as a whole: all its words do, or stand beside one that does
(``cookie-notice``, ``site-footer``; not ``social-science``, ``menu-of-the-day``).
Each line's weight is its text outside links; sums over ``WINDOW`` lines form
the distribution.  Where the sum leaves zero is a surge, where it returns to
zero a dive, and the text in between is kept unless most of it is links.  A line
in a marked article weighs ``MARK`` times as much, and the mark's ends are blank;
a stretch outside stays when its peak reaches the median of those inside.
On pages without a mark every such stretch stays.  Lines of links at the edges of
a stretch go where no mark holds them; those between lines of text stay.

Edge cases: null or empty html and pages without text give an empty string;
unclosed tags end with their parent, and an article that starts inside an
unclosed notice or advert ends it (in a closed one it is skipped with it); a ``<`` that opens no tag is text; pages of
any length are read whole; repeated rows and null urls stay; extra columns are
ignored.
"""

from __future__ import annotations

import html as charrefs
import re
from statistics import median

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import ship

WINDOW = 3
MARK = 4                   # weight of a line in a marked article

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|textarea|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][\w:-]*)[^>]*>",
    re.S | re.I)
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("head nav footer aside form button select menu dialog object".split())
_ARTICLE = frozenset(("article", "main"))
_NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner sidebar "
    "sidenav cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login search "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer "
    "share sharing social related recommended comment comments commentlist disqus replies respond widget "
    "complementary contentinfo skip".split())
_REPLIES = frozenset(("comment", "comments", "commentlist", "disqus", "replies", "respond"))
# Words that may stand beside one of the above in a name: they say where or how, not what.
_BESIDE = frozenset(
    "site page main top bottom left right upper lower inner outer primary secondary global mobile desktop sticky fixed "
    "inline floating box wrap wrapper container area bar list links link item items block section module panel row col "
    "column grid slot unit text message icon icons button buttons form input post posts article articles entry story "
    "content the a an of and for with by to us our your this more follow on in".split())
_OWN = frozenset("post article entry story content".split())   # whose header is the article's own


def _noise(name: str, attrs: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element holds no article text, and whether it holds reader comments."""
    if name in _NEVER or (name == "header" and not inside):
        return True, False
    if not attrs or name in ("html", "body"):
        return False, False
    if _HIDDEN.search(attrs):
        return True, False
    names = [n for m in _NAMED.finditer(attrs) for n in m[1].lower().strip("\"'").split()]
    noisy = [words for words in map(_words, names) if words & _NOISE and words <= _NOISE | _BESIDE
             and not (words & _OWN and "header" in words)]
    replies = any(words & _REPLIES for words in noisy)
    if name in _ARTICLE or (inside and name in ("header", "h1", "h2")):
        return replies, replies
    return bool(noisy), replies


def _words(name: str) -> set[str]:
    """The words of one class name or id: ``cookie-notice``, ``adBox_2``."""
    return {w for w in re.split(r"[^a-z]+", name) if w}


def _unclosed(tokens: list[re.Match]) -> set[int]:
    """Offsets of start tags without an end tag, and of those inside an unclosed element of their name."""
    open_tags: list[tuple[str, int]] = []
    found: set[int] = set()
    inside: list[tuple[int, list[int]]] = []               # a closed element, and those of its name it lies in
    for m in tokens:
        name = (m["name"] or m["name2"] or "").lower()
        if not name or name in _VOID:
            continue
        if not (m["end"] or m["end2"]):
            if not ((m["attrs"] or "").endswith("/") and name not in _BLOCKS):
                open_tags.append((name, m.start()))
            continue
        for i in range(len(open_tags) - 1, -1, -1):
            if open_tags[i][0] == name:
                found.update(at for _, at in open_tags[i + 1:])
                inside.append((open_tags[i][1], [at for n, at in open_tags[:i] if n == name]))
                del open_tags[i:]
                break
    found.update(at for _, at in open_tags)
    return found | {at for at, around in inside if not found.isdisjoint(around)}


def lines(html: str) -> tuple[list[tuple[str, int, bool]], bool]:
    """Lines as (text, weight, in the article), blank ones for stripped elements; whether an article is marked."""
    out: list[tuple[str, int, bool]] = []
    open_tags: list[tuple[str, bool, bool, int]] = []     # name, starts a skipped element, reader comments, offset
    text: list[str] = []
    linked = skipped = inside = links = 0
    marked = False

    def flush():
        nonlocal linked
        if text:
            line = " ".join("".join(text).split())
            if line:
                out.append((line, max(0, len(line) - linked), inside > 0))
            text.clear()
        linked = 0

    def close(at: int):
        nonlocal skipped, inside, links
        while len(open_tags) > at:
            name, skip, _, _ = open_tags.pop()
            if skip:
                skipped -= 1
                if not skipped:
                    out.extend([("", 0, False)] * WINDOW)
            elif name in _ARTICLE:
                flush()
                inside -= 1
                if not inside:
                    out.extend([("", 0, False)] * WINDOW)
            links -= name == "a"

    def say(raw: str):
        nonlocal linked
        if raw and not skipped:
            piece = charrefs.unescape(raw) if "&" in raw else raw
            text.append(piece)
            if links:
                linked += len(piece.strip())

    at = 0
    tokens = list(_TOKEN.finditer(html))
    unclosed: set[int] | None = None
    for m in tokens:
        say(html[at:m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if name in _BLOCKS:
            flush()
        if m["end"] or m["end2"]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    close(i)
                    break
            continue
        if name in _VOID:
            continue
        attrs = m["attrs"] or ""
        if attrs.endswith("/") and name not in _BLOCKS:
            continue
        if name in _BLOCKS or name in _ARTICLE:             # these end an open paragraph
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == "p":
                    close(i)
                    break
                if open_tags[i][0] in _BLOCKS:
                    break
        skip, replies = _noise(name, attrs, inside > 0)
        if name in _ARTICLE and not skip:
            if skipped and not any(x[2] for x in open_tags):
                unclosed = _unclosed(tokens) if unclosed is None else unclosed
                around = [i for i, x in enumerate(open_tags) if x[1]]
                if all(open_tags[i][3] in unclosed for i in around):
                    close(around[0])
            if not skipped:
                if not inside:
                    out.extend([("", 0, False)] * WINDOW)
                inside += 1
                marked = True
                open_tags.append((name, False, False, m.start()))
                continue
        open_tags.append((name, skip or bool(skipped and name in _ARTICLE), replies, m.start()))
        skipped += open_tags[-1][1]
        links += name == "a"
    say(html[at:])
    flush()
    return out, marked


def main_text(html: str | None) -> str:
    """The article's blocks, one per line."""
    found, marked = lines(html or "")
    weight = [w * MARK if here else w for _, w, here in found]
    n = len(found)
    run = [0]
    for w in weight:
        run.append(run[-1] + w)
    block = [run[min(n, i + WINDOW)] - run[i] for i in range(n)]
    stretches, start = [], None
    for i in range(n + 1):
        up = i < n and block[i] > 0
        if up and start is None:
            start = i                                      # surge
        elif not up and start is not None:
            stretches.append((start, i))                   # dive
            start = None
    kept = []
    for a, b in stretches:
        while a < b and (not found[a][2] and found[a][1] * 2 < len(found[a][0]) or not found[a][0]):
            a += 1                                         # links and blanks before the text
        while a < b and (not found[b - 1][2] and found[b - 1][1] * 2 < len(found[b - 1][0]) or not found[b - 1][0]):
            b -= 1
        if a < b and 2 * sum(found[i][1] for i in range(a, b)) >= sum(len(found[i][0]) for i in range(a, b)):
            kept.append((a, b))
    bars = [block[i] for a, b in kept for i in range(a, b) if found[i][2]]
    bar = median(bars) if bars else 0
    return "\n".join(found[i][0] for a, b in kept if found[a][2] or max(block[a:b]) >= bar
                     for i in range(a, b) if found[i][0])


def _extract(batches):
    for pdf in batches:
        text = [main_text(h) for h in pdf["html"]]
        yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "text": text,
                            "n_chars": [len(t) for t in text]})


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    ship(pages.sparkSession)
    return pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    ).mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
