"""Main text of HTML pages by two-pass block rules.

Markup is cut into blocks at block-level tags. A block inside a part that is not the article (navigation,
header, footer, sidebar, notice, advert, form, reader comments: by element, role or the words of class and
id) is out, but for the headings of an article's own header; a form that holds most of the text that pass one decides to
be in, or an element whose class or id holds such a word and nine tenths of that text, wraps the page and puts nothing
out. Links are ``a`` with href; one without a closing tag of its own ends at the next block or link. Pass one decides every other block by its own text: with many links it is out, long with enough
stop words it is in, long with links and, in Latin script, without any it is out. The rest, headings and short blocks, is
ambiguous, and pass two gives it the label of the nearest decided neighbours: of two that disagree the nearer
one's, at equal distance it is out unless it is a heading, which goes with what follows.

A declared part (article, main) is one feature of this. The one that holds most of the text that pass one
decided to be in, else all of them together if they hold as much as is outside give or take two short blocks,
leads: pass one is repeated with a bias. Inside, twice the share of links is allowed, a linked heading is
ambiguous, and nothing is out for lack of stop words alone; outside, only a block three times as long with twice the stop words is in. Pass two
then looks for neighbours on the block's own side of the part's border, inside not at parts that are out, and
where there are none, or of two at equal distance, the side decides. Without a leading part there is no bias.
Class and id words put an article out too, unless those so named hold most of the decided text.

Each page is one row of work; pages are independent and nothing is shuffled.

Defined results: null or empty html, or a page without such blocks, gives the empty text; unclosed
elements end with their parents, unclosed comments, scripts and styles at the end of the page, other unclosed
elements without text (title, button, select, object and the like) at the body or the next block element's
tag, an unfinished tag at its end is dropped; a quoted value ends at a quote before white space or the tag's end, a
stray quote is part of the tag; repeated rows give equal results; other columns pass through except one named
``text``, which is replaced; an empty table stays empty; a page of any length is read to its end.
"""

from __future__ import annotations

import html as htmllib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_engine.llm.quality_rules import STOP_WORDS

STOP = frozenset(w for words in STOP_WORDS.values() for w in words.split())

#: Elements whose content is never text of the page; the first two end at their first closing tag, whatever is inside.
_RAW = "script|style|noscript|template|svg|math|iframe|object|select|textarea|button|canvas|video|audio|title"
_TO_END = {x: re.compile(rf"</{x}\s*>|\Z", re.I) for x in _RAW.split("|")[:2]}
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<raw>{_RAW})(?![\w:-])[^>]*(?<!/)>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')(?=[\s/>]|\Z)|[^>])*)(?:>|\Z)", re.S | re.I)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_LINK_TAG = re.compile(r"<(/?)a(?![\w:-])", re.I)

_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr
ul caption""".split())
_RAW_TAG = {x: re.compile(rf"<(?:(?P<close>/){x}\s*|{x}(?![\w:-])[^>]*(?<!/))>", re.I) for x in _RAW.split("|")}
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCK))})(?![\w:-])", re.I)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_NO_END = frozenset("hr p".split())
_MAIN = frozenset("article main".split())
_OUT_TAG = frozenset("nav header footer aside form menu dialog".split())
_OUT_ROLE = frozenset("navigation banner contentinfo search complementary dialog alert form menu menubar".split())
#: Words of a class or id that name a part outside the article.
_OUT_WORD = frozenset("""ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent
gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar side menu nav navbar navigation breadcrumb
breadcrumbs footer header masthead topbar toolbar comment comments reply replies disqus share sharing social related recommended
pagination pager login signup search widget hidden""".split())


#: Share of the page's decided text above which an element is no part outside the article but wraps it, by what
#: names it: a form, or words of its class and id. Other elements and roles are always outside.
_WRAPS = {"form": 0.5, "word": 0.9}


class _Outside:
    """An open element outside the article: the one around it, and the share above which it is none."""
    __slots__ = ("around", "share", "of_article")

    def __init__(self, around: int, share: float, of_article: bool):
        self.around, self.share, self.of_article = around, share, of_article


class _Block:
    __slots__ = ("parts", "linked", "heading", "out", "main", "named")

    def __init__(self, heading: bool, out: int, main: int, named: bool):
        self.parts: list[str] = []
        self.linked, self.heading, self.out, self.main, self.named = 0, heading, out, main, named


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(raw)} if raw.strip() else {}


def _leads_out(tag: str, raw: str) -> float | None:
    """Whether an element is outside the article: the share of text above which it is not, None if it never is."""
    plain = "=" not in raw and "hidden" not in raw.lower()
    if tag in _OUT_TAG:
        return _WRAPS["form"] if tag == "form" and (plain or not _out_role(_attributes(raw))) else 2
    if plain:
        return None
    a = _attributes(raw)
    if _out_role(a):
        return 2
    return _WRAPS["word"] if tag not in _MAIN and tag not in ("body", "html") and _out_words(a) else None


def _out_role(a: dict[str, str]) -> bool:
    return a.get("role", "").lower() in _OUT_ROLE or "hidden" in a or a.get("aria-hidden", "") == "true" or bool(
        re.search(r"display\s*:\s*none", a.get("style", "")))


def _out_words(a: dict[str, str]) -> bool:
    words = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", a.get("class", "") + " " + a.get("id", "")).lower())
    return not _OUT_WORD.isdisjoint(words)


def _raw_ends(page: str, name: str) -> dict[int, int]:
    """Where the closed elements of a name end, by where their content begins."""
    ends: dict[int, int] = {}
    open_at: list[int] = []
    for m in _RAW_TAG[name].finditer(page):
        if not m["close"]:
            open_at.append(m.end())
        elif open_at:
            ends[open_at.pop()] = m.end()
    return ends


def _closed_links(page: str) -> set[int]:
    """Where links begin whose closing tag comes before the next link."""
    closed, last = set(), -1
    for m in _LINK_TAG.finditer(page):
        if m[1] and last >= 0:
            closed.add(last)
        last = -1 if m[1] else m.start()
    return closed


def blocks_of(page: str) -> tuple[list[tuple[str, float, bool, int, int, bool]], list[_Outside]]:
    """(text, share of it in links, heading, innermost element outside the article or -1, number of the outermost declared part
    or 0, in an article whose class or id names a part outside) in page order, and the elements outside."""
    blocks = [_Block(False, -1, 0, False)]
    outside: list[_Outside] = []
    stack: list[tuple[str, int, int, bool]] = []  # open block elements: tag, out, main, named
    open_tags: dict[str, int] = {}
    link, at, declared = "", 0, 0  # an open link: "closed" by a tag of its own, or "loose"
    closed = _closed_links(page)
    raw_ends: dict[str, dict[int, int]] = {}

    def text(s: str) -> None:
        if s:
            blocks[-1].parts.append(htmllib.unescape(s) if "&" in s else s)
            if link:
                blocks[-1].linked += len("".join(s.split()))

    def leads_out(tag: str, attrs: str, out: int, main: int) -> int:
        share = _leads_out(tag, attrs)
        if share is None:
            return out
        outside.append(_Outside(out, share, tag == "header" and main > 0))
        return len(outside) - 1

    while m := _MARKUP.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        if m["raw"]:
            raw = m["raw"].lower()
            if raw in _TO_END:
                at = _TO_END[raw].search(page, at).end()
                continue
            if raw not in raw_ends:
                raw_ends[raw] = _raw_ends(page, raw)
            after = None if at in raw_ends[raw] else _BLOCK_TAG.search(page, at)
            at = after.start() if after else raw_ends[raw].get(at, len(page))
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            link = "" if m["close"] or "href" not in _attributes(m["attrs"]) else "closed" if m.start() in closed else "loose"
        elif tag == "br":
            text(" ")
        elif tag in _BLOCK:
            link = "" if link == "loose" else link
            if m["close"]:
                if open_tags.get(tag):
                    while True:
                        last = stack.pop()[0]
                        open_tags[last] -= 1
                        if last == tag:
                            break
            elif tag not in _NO_END:
                out, main, named = stack[-1][1:] if stack else (-1, 0, False)
                inside = main
                if not main and (tag in _MAIN or "main" in re.findall(r"role\s*=\s*[\"']?(\w+)", m["attrs"])):
                    declared += 1
                    main = declared
                named = named or tag == "article" and _out_words(_attributes(m["attrs"]))
                stack.append((tag, leads_out(tag, m["attrs"], out, inside), main, named))
                open_tags[tag] = open_tags.get(tag, 0) + 1
            out, main, named = stack[-1][1:] if stack else (-1, 0, False)
            heading = tag in _HEADING and not m["close"]
            if tag == "p" and not m["close"]:
                out = leads_out(tag, m["attrs"], out, main)
            elif heading and out >= 0 and outside[out].of_article:
                out = outside[out].around  # the heading of an article's own header
            blocks.append(_Block(heading, out, main, named))
    text(page[at:])
    found = []
    for b in blocks:
        words = " ".join("".join(b.parts).split())
        if words:
            found.append((words, b.linked / max(1, len(words) - words.count(" ")), b.heading, b.out, b.main, b.named))
    return found, outside


def _first_pass(words: str, linked: float, heading: bool, side: int, max_links: float, short: int, min_stop: float) -> bool | None:
    """In, out or ambiguous by the block's own text; ``side`` 1: in the leading part, -1: outside it, 0: there is none."""
    if linked > max_links * (2 if side > 0 else 1):
        return None if heading and side > 0 else False
    if heading or len(words) < short:
        return None
    w = words.lower().split()
    stop = sum(x in STOP for x in w) / len(w)
    if side < 0 and len(words) < 3 * short:
        return None
    if stop >= min_stop * (2 if side < 0 else 1):
        return True
    return False if stop == 0 and linked > 0 and side <= 0 and _latin(words) else None


def _latin(words: str) -> bool:
    """Most letters are of the script that the stop words are written in."""
    letters = [c for c in words if c.isalpha()]
    return 2 * sum(c < "\u0250" for c in letters) >= len(letters)


def _outside(blocks, outside: list[_Outside], first: list[bool | None]) -> list[bool]:
    """Blocks outside the article by structure: in an element outside that doesn't hold most of the decided text."""
    held = [0] * (len(outside) + 1)  # the last place is for blocks in none
    for b, x in zip(blocks, first):
        held[b[3]] += len(b[0]) if x else 0
    for i in range(len(outside) - 1, -1, -1):  # an element stands after the one around it
        held[outside[i].around] += held[i]
    out = [False] * (len(outside) + 1)
    for i, x in enumerate(outside):
        out[i] = out[x.around] or held[i] <= x.share * held[-1]
    return [out[b[3]] for b in blocks]


def _leading(blocks, first: list[bool | None], out: list[bool], short: int) -> set[int]:
    """Numbers of the declared parts that lead: the one with most of the decided text, else all of them if
    their text and that of two short blocks is no less than what is outside, else none."""
    inside: dict[int, int] = {}
    for b, x, gone in zip(blocks, first, out):
        if not gone:
            inside[b[4]] = inside.get(b[4], 0) + (len(b[0]) if x else 0)
    outside, parts = inside.pop(0, 0), set(inside)
    total = outside + sum(inside.values())
    best = max(parts, key=inside.__getitem__, default=0)
    if best and 2 * inside[best] > total:
        return {best}
    return parts if total - outside + 2 * short >= outside else set()


def classify(blocks, outside: list[_Outside], max_links: float = 0.33, short: int = 70, min_stop: float = 0.10) -> list[bool]:
    """Keep or drop for every block."""
    bounds = (max_links, short, min_stop)
    plain = [_first_pass(*b[:3], 0, *bounds) for b in blocks]
    structure = _outside(blocks, outside, plain)
    label = [False if out else x for out, x in zip(structure, plain)]
    named = sum(len(b[0]) for b, x in zip(blocks, label) if x and b[5])
    named_out = 2 * named <= sum(len(b[0]) for b, x in zip(blocks, label) if x)
    gone = [out or b[5] and named_out for b, out in zip(blocks, structure)]
    lead = _leading(blocks, label, gone, short)
    side = [0 if not lead else 1 if b[4] in lead else -1 for b in blocks]
    label = [False if x else _first_pass(*b[:3], s, *bounds) if s else y for b, x, s, y in zip(blocks, gone, side, label)]
    # neighbours are looked for on the block's own side; in the leading part, adverts and the like are none
    decided = [x is not None and not (gone[i] and side[i] > 0) for i, x in enumerate(label)]
    before: list[tuple[int, bool] | None] = []
    last: dict[int, tuple[int, bool]] = {}
    for i, x in enumerate(label):
        if decided[i]:
            last[side[i]] = (i, x)
        before.append(last.get(side[i]))
    keep, behind = [False] * len(label), {}
    for i in range(len(label) - 1, -1, -1):
        if decided[i]:
            behind[side[i]] = (i, label[i])
        if label[i] is not None:
            keep[i] = label[i]
            continue
        prev, after = before[i], behind.get(side[i])
        if prev is None or after is None:
            keep[i] = (prev or after or (0, side[i] >= 0))[1]
        elif blocks[i][2]:
            keep[i] = after[1]
        elif prev[1] == after[1]:
            keep[i] = prev[1]
        else:
            keep[i] = (prev if i - prev[0] < after[0] - i else after)[1] if i - prev[0] != after[0] - i else side[i] > 0
    return keep


def main_text(page: str | None) -> str:
    blocks, outside = blocks_of(page or "")
    return "\n\n".join(b[0] for b, keep in zip(blocks, classify(blocks, outside)) if keep)


def _extract(batches):
    for batch in batches:
        texts = [main_text(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns of ``pages`` but ``html`` and ``text``, plus the main text as ``text``."""
    keep = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "text")]
    rows = pages.select(*keep, F.col(html).alias("_html_"))
    return rows.mapInArrow(_extract, pages.select(*keep).schema.add("text", "string"))
