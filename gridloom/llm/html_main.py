"""The main text of web pages, by the distribution of text over line blocks.

Markup is stripped, one line a block, and each line weighs as much text as it has outside links.  Weights are summed over
a sliding window of lines: the text surges where the sum leaves the ground and dives where it comes back, and the stretch
with most text between the two is the core.  Lines in boxes that the markup marks (menus, headers, footers, sidebars,
forms, adverts, readers' comments, hidden parts) have no weight, however much text they hold: they count only on a page
where no other box holds text, and then first without what is hidden or readers' comments.  A marked box around a ``main``
element is the page's frame, as is a form around its parts, and isn't marked; nor is, on a page without another article
or main element, a box around a single one that only its name marks.

Readers' comments are told by their markup, or by how they stand: under a heading that counts or asks for comments, to the
end of its box or the next heading as high; or as two boxes or more side by side that each offer to reply.

The article is then the ``article`` or ``main`` element that holds most of the core, the outermost if they nest; or else
the smallest box around all of the core that isn't itself a part of a text (a list, a table, a quotation, a section), or
else the page.  In an element of the first kind every line is kept, short ones too.  In the others, what lies outside the
stretch is kept only where it stands side by side with the core: not in a box of its own without any of it, and not if it
is mostly links.  Lines in boxes that the markup marks go.

Defined cases: a null or empty page, and one without text, give an empty string; unclosed and misplaced tags end where
an enclosing box ends, a tag without its ``>`` at the next tag; elements without text to read (SKIPPED) end at their own
tag if they close themselves or are never closed; pages of any length and nesting take time in proportion to their length;
pages that repeat an id are pages of their own; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines in a sliding window.
WINDOW = 3
NAME = re.compile(r"[a-zA-Z][\w:-]*")
BEFORE = re.compile(r"[\s/]*")
ATTRIBUTE = re.compile(r"[^\s/>=<]+")
EQUALS = re.compile(r"\s*=\s*")
BARE = re.compile(r"[^\s>]*")
#: Elements whose content is not markup: to the end of the page if they are never closed.
RAW = frozenset(("script", "style"))
#: And such that end at their own tag then, or where another one opens.
PLAIN = frozenset("noscript textarea iframe title".split())
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW}
PLAIN_NEXT = {t: re.compile(rf"<(/?){t}\b", re.I) for t in PLAIN}
#: Elements that are left out with what they hold, and may nest.
SKIPPED = frozenset("svg object select template annotation annotation-xml".split())
BOX = frozenset("html head body main article section div header footer nav aside form ul ol dl table thead tbody tfoot tr td th figure details dialog fieldset blockquote menu center".split())
BLOCK = BOX | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address caption figcaption legend option summary".split())
#: Boxes that are parts of a text rather than hold one.
PARTS = frozenset("ul ol dl table thead tbody tfoot tr figure details blockquote section".split())
#: Elements that end when one opens, up to the box that bounds them.
ENDS = {"td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",))}
#: Elements that are not the article.
OFF = frozenset("head nav footer aside form menu dialog fieldset button".split())
OFF_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: What class names and ids say so too: a whole name, or what is left of it once words for containers are taken off its end.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promotions sidebar sidebars "
    "menu menus nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices banner banners newsletter "
    "subscribe subscription signup related recommended recommendations share sharing social footer foot masthead topbar popup modal "
    "overlay toolbar pagination pager login search disclaimer complementary contentinfo skip".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
CONTAINERS = frozenset("box container wrapper wrap inner outer block section area list item items region panel bar content body group holder slot unit links buttons icons form message text row column col widget widgets top bottom left right main".split())
MASTHEAD = frozenset(("header", "head"))
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
HEADING = re.compile(r"h[1-6]\Z")
NEGATION = frozenset(("no", "has", "with", "without", "hide", "is", "not"))
NOTICE = re.compile(r"(?:©|\(c\)|copyright\b)|.*\b(?:all rights reserved|alle rechte vorbehalten|tous droits réservés|todos los derechos reservados)\b", re.I)
#: Headings over readers' comments, and what offers to reply to one: fixed words of four languages.
COMMENTS_HEAD = re.compile(
    r"(?:\d+\s+)?(?:reader |user |leser|les )?(?:comments?|responses?|replies|discussion|kommentare?|leserkommentare|antworten|commentaires?|réponses?|comentarios?|respuestas?)(?:\s*[(\[]?\s*\d+\s*[)\]]?)?\s*:?"
    r"|(?:leave|post|write|add) (?:a|your) (?:comment|reply)|join the (?:discussion|conversation)|(?:schreiben sie )?(?:einen )?kommentar (?:schreiben|hinterlassen|verfassen)|laisser un commentaire|ajouter un commentaire|dej[ae] un comentario|dejar un comentario|escrib[ae] un comentario",
    re.I,
)
REPLY = re.compile(r"(?:reply|antworten|répondre|responder)\W*", re.I)
#: How the markup judges a box: nothing to say; hardly the article; readers' comments, or hidden.
NEUTRAL, MARKED, NEVER = range(3)


@dataclass
class Boxes:
    """The elements that hold lines, in the order in which they open: a box's number is above its parent's."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    mark: list[int] = field(default_factory=list)
    semantic: list[bool] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)  # an article or main element, itself included

    def add(self, tag: str, parent: int, mark: int, semantic: bool) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.mark.append(mark)
        self.semantic.append(semantic)
        self.inside.append(semantic or (parent >= 0 and self.inside[parent]))
        return len(self.tag) - 1

    def inherited(self) -> list[int]:
        """The gravest mark of each box and those around it."""
        out: list[int] = []
        for mark, parent in zip(self.mark, self.parent, strict=True):
            out.append(max(mark, out[parent]) if parent >= 0 else mark)
        return out

    def summed(self, lines: list[Line], values: list[int]) -> list[int]:
        """For each box, the sum over the lines in it, at any depth."""
        out = [0] * len(self.tag)
        for line, value in zip(lines, values, strict=True):
            if line.box >= 0:
                out[line.box] += value
        for k in range(len(out) - 1, -1, -1):
            if self.parent[k] >= 0:
                out[self.parent[k]] += out[k]
        return out


@dataclass
class Line:
    text: str
    weight: int
    box: int
    level: int = 0  # of a heading, from 1 to 6


def _attributes(page: str, at: int, last: dict[str, int]) -> tuple[dict[str, str], int, bool]:
    """The attributes of a tag from the end of its name on, where it ends (-1: nowhere), and whether it closes itself."""
    own: dict[str, str] = {}
    while True:
        start, at = at, BEFORE.match(page, at).end()
        if at >= len(page):
            return own, -1, False
        c = page[at]
        if c == ">":
            return own, at + 1, "/" in page[start:at]
        if c == "<":
            return own, at, False
        if not (m := ATTRIBUTE.match(page, at)):
            at += 1  # a stray equals sign
            continue
        name, at, value = m[0].lower(), m.end(), ""
        if m := EQUALS.match(page, at):
            at = m.end()
            quote = page[at : at + 1]
            if quote in ('"', "'") and quote and at < last[quote]:
                end = page.index(quote, at + 1)
                value, at = page[at + 1 : end], end + 1
            else:
                m = BARE.match(page, at)
                value, at = m[0], m.end()
        own.setdefault(name, value)


def tokens_of(page: str) -> Iterator[tuple[str, bool, dict[str, str] | None, str]]:
    """(tag, closing, attributes, "") of each tag, and ("", False, None, text) of each stretch of text.

    Comments, declarations, scripts and styles are left out.  Each character is looked at a bounded number of times.
    """
    last = {q: page.rfind(q) for q in ('"', "'")}
    never: set[str] = set()  # elements of which no end tag is left
    at = 0
    while at < len(page):
        open_at = page.find("<", at)
        if open_at != at:
            yield "", False, None, page[at : open_at if open_at >= 0 else len(page)]
            if open_at < 0:
                return
        at = open_at
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = end + 3 if end >= 0 else len(page)
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at + 9)
            at = end + 3 if end >= 0 else len(page)
        elif page[at + 1 : at + 2] in ("!", "?"):
            end = page.find(">", at)
            at = end + 1 if end >= 0 else len(page)
        else:
            closing = page[at + 1 : at + 2] == "/"
            name = NAME.match(page, at + 1 + closing)
            if not name:
                yield "", False, None, "<"
                at += 1
                continue
            tag = name[0].lower()
            own, end, closed = {}, name.end(), False
            if page[end : end + 1] == ">":
                end += 1
            elif page[end : end + 1] != "<":
                own, end, closed = _attributes(page, end, last)
            if end < 0:  # it runs into the end of the page: no tag
                yield "", False, None, page[at:]
                return
            at = end
            if closed and tag in SKIPPED:
                continue
            if tag in RAW and not closing and not closed:
                end_tag = RAW_END[tag].search(page, at)
                at = end_tag.end() if end_tag else len(page)
                continue
            if tag in PLAIN and not closing and not closed and tag not in never:
                other = PLAIN_NEXT[tag].search(page, at)
                if not other:
                    never.add(tag)
                elif other[1]:
                    end = page.find(">", other.end())
                    at = end + 1 if end >= 0 else len(page)
                    continue
            yield tag, closing, own, ""


def _skipped(tokens: list[tuple]) -> dict[int, int]:
    """Where, among the tokens, each skipped element that is closed starts and ends."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for k, (tag, closing, _, _) in enumerate(tokens):
        if tag in SKIPPED:
            if not closing:
                opened.setdefault(tag, []).append(k)
            elif opened.get(tag):
                found[opened[tag].pop()] = k
    return found


def _named(name: str, inside: bool) -> int:
    """What one class name or id says."""
    parts = [p.lower() for p in PART.findall(name)]
    if not parts or not NEGATION.isdisjoint(parts):
        return NEUTRAL
    if name.lower() == "hidden":
        return NEVER
    while len(parts) > 1 and (parts[-1] in CONTAINERS or parts[-1].isdigit()):
        parts.pop()
    if parts[-1] in COMMENTS:
        return NEVER
    if parts[-1] in MARKS or (parts[-1] in MASTHEAD and not inside and {"article", "entry", "post"}.isdisjoint(parts)):
        return MARKED
    return NEUTRAL


def _mark(tag: str, own: dict[str, str], inside: bool) -> int:
    """What an element's markup says of it.  inside: of an article or main element."""
    if "hidden" in own or own.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", own.get("style", "")):
        return NEVER
    if tag in OFF or (tag == "header" and not inside) or own.get("role", "").lower() in OFF_ROLES:
        return NEVER if tag == "head" else MARKED
    if tag in ("html", "body", "main"):
        return NEUTRAL
    return max((_named(n, inside) for k in ("class", "id") for n in own.get(k, "").split()), default=NEUTRAL)


def lines_of(page: str | None) -> tuple[list[Line], Boxes]:
    """The page's lines that hold text, and its boxes by number."""
    boxes = Boxes()
    stack: list[int] = []
    opened: Counter[str] = Counter()
    lines: list[Line] = []
    text: list[str] = []
    linked = link = level = 0
    body = False

    def end() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split()) if text else ""
        if joined:
            lines.append(Line(joined, max(0, len(joined) - linked), stack[-1] if stack else -1, level))
        text.clear()
        linked = 0

    def push(tag: str, mark: int, semantic: bool) -> None:
        stack.append(boxes.add(tag, stack[-1] if stack else -1, mark, semantic))
        opened[tag] += 1

    def pop() -> None:
        opened[boxes.tag[stack.pop()]] -= 1

    def own_kind() -> bool:
        return bool(stack) and boxes.tag[stack[-1]].startswith("~")

    tokens = list(tokens_of(page or ""))
    skipped, upto = _skipped(tokens), -1
    for k, (tag, closing, own, words) in enumerate(tokens):
        if k <= upto:
            continue
        if k in skipped:
            upto = skipped[k]
            continue
        if not tag:
            text.append(words)
            if link:
                linked += len(words)
            continue
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            link = 0 if closing else 1
        if tag not in BLOCK and tag not in OFF:
            continue
        end()
        link = 0
        level = int(tag[1]) if HEADING.match(tag) and not closing else 0
        if tag not in BOX and tag not in OFF:
            if closing or not (mark := _mark(tag, own, True)):
                while own_kind() and (not closing or boxes.tag[stack[-1]] == "~" + tag):
                    pop()
            else:
                push("~" + tag, mark, False)  # a paragraph of its own kind, up to the next one
        elif closing:
            if opened[tag]:
                while boxes.tag[stack[-1]] != tag:
                    pop()
                pop()
        else:
            while own_kind():
                pop()
            if tag == "body" and not body:
                body = True
                while opened["head"]:
                    pop()
            ends, bounds = ENDS.get(tag, ((), ()))
            if any(opened[t] for t in ends):  # a new cell ends the one before it, a new row too
                depth = len(stack) - 1
                while depth >= 0 and boxes.tag[stack[depth]] not in ends and boxes.tag[stack[depth]] not in bounds:
                    depth -= 1
                if depth >= 0 and boxes.tag[stack[depth]] in ends:
                    while len(stack) > depth:
                        pop()
            mark = _mark(tag, own, bool(stack) and boxes.inside[stack[-1]])
            semantic = mark == NEUTRAL and (tag in ("article", "main") or own.get("role", "").lower() in ("main", "article") or "articlebody" in own.get("itemprop", "").lower())
            push(tag, mark, semantic)
    end()
    return lines, boxes


def core(weights: np.ndarray, window: int = WINDOW) -> tuple[int, int]:
    """First and last line of the stretch with most text between a surge and the next dive; (0, -1) without text.

    A line is in a stretch if the sums over the window that ends with it and over the one that begins with it are both
    above the ground, a tenth of the largest sum or 80 characters.  Of equal stretches the first.
    """
    if not weights.any():
        return 0, -1
    total, k = np.concatenate([[0], np.cumsum(weights)]), np.arange(len(weights))
    before, after = total[k + 1] - total[np.maximum(k + 1 - window, 0)], total[np.minimum(k + window, len(weights))] - total[k]
    ground = min(int(before.max()) // 10, 80)
    up = np.concatenate([[0], (before > ground) & (after > ground), [0]]).astype(np.int8)
    starts, ends = np.flatnonzero(np.diff(up) == 1), np.flatnonzero(np.diff(up) == -1)
    if not len(starts):
        top = int(weights.argmax())
        return top, top
    best = int((total[ends] - total[starts]).argmax())
    return int(starts[best]), int(ends[best]) - 1


def _frames(boxes: Boxes) -> None:
    """A marked box around a main element, or a form around a page's parts, is no mark; nor, on a page without another
    article, is a box marked by its name around a single one."""
    n = len(boxes.tag)
    marks, articles = boxes.inherited(), [0] * n
    other = any(s and m == NEUTRAL for s, m in zip(boxes.semantic, marks, strict=True))
    held: list[set[str]] = [set() for _ in range(n)]
    for k in range(n - 1, -1, -1):
        own = {"main"} if boxes.semantic[k] and boxes.tag[k] != "article" else {boxes.tag[k]} & {"article", "nav", "header", "footer"}
        if boxes.mark[k] == MARKED and ("main" in held[k] or (boxes.tag[k] == "form" and held[k]) or (not other and articles[k] == 1 and boxes.tag[k] not in OFF)):
            boxes.mark[k] = NEUTRAL
        if boxes.parent[k] >= 0:
            held[boxes.parent[k]] |= held[k] | own
            articles[boxes.parent[k]] += articles[k] + (boxes.tag[k] == "article")


def _comments(lines: list[Line], boxes: Boxes) -> list[bool]:
    """Which lines are readers' comments by how they stand; boxes that are nothing else are marked."""
    n = len(boxes.tag)
    size, heads = boxes.summed(lines, [1] * len(lines)), boxes.summed(lines, [int(x.level == 1) for x in lines])
    at: dict[int, int] = {}  # each box's first line
    for k, x in enumerate(lines):
        box = x.box
        while box >= 0 and box not in at:
            at[box] = k
            box = boxes.parent[box]
    out = [False] * len(lines)
    for k, x in enumerate(lines):
        if x.level < 2 or out[k] or not COMMENTS_HEAD.fullmatch(x.text):  # the first level is the page's own
            continue
        last = at[x.box] + size[x.box] if x.box >= 0 else len(lines)
        end = next((j for j in range(k + 1, last) if 0 < lines[j].level <= x.level and lines[j].box == x.box), last)
        out[k:end] = [True] * (end - k)
    offers: dict[int, set[int]] = {}  # boxes that offer to reply, by the box around them
    for x in lines:
        if x.box >= 0 and REPLY.fullmatch(x.text):
            child, box = x.box, boxes.parent[x.box]
            while box >= 0 and not (heads[box] or boxes.semantic[box] or boxes.tag[box] in ("html", "body")):
                offers.setdefault(box, set()).add(child)
                child, box = box, boxes.parent[box]
    for k in range(n):
        if len(offers.get(k, ())) > 1:
            boxes.mark[k] = NEVER
    return out


def main_text(page: str | None, window: int = WINDOW) -> str:
    """The article's blocks, joined by empty lines."""
    lines, boxes = lines_of(page)
    _frames(boxes)
    said = _comments(lines, boxes)
    full = np.array([x.weight for x in lines], np.int64)
    marks = boxes.inherited()
    mark = np.array([NEVER if c else marks[x.box] if x.box >= 0 else NEUTRAL for x, c in zip(lines, said, strict=True)], np.int64)
    worst = next((m for m in (NEUTRAL, MARKED, NEVER) if full[mark <= m].any()), NEUTRAL)
    weights = np.where(mark <= worst, full, 0)
    low, high = core(weights, window)
    if high < low:
        return ""
    if worst > NEUTRAL:  # nothing but what the markup marks: it says nothing then
        boxes.mark = [m if m > worst else NEUTRAL for m in boxes.mark]
        boxes.semantic = [s or t in ("article", "main") for s, t in zip(boxes.semantic, boxes.tag, strict=True)]
        said = [c and worst < NEVER for c in said]
    stretch = np.zeros(len(lines), np.int64)
    stretch[low : high + 1] = 1
    heavy = stretch * (weights > 0)
    total, share = int((weights * stretch).sum()), boxes.summed(lines, (weights * stretch).tolist())
    marks = boxes.inherited()
    off = [c or (x.box >= 0 and marks[x.box] > NEUTRAL) for x, c in zip(lines, said, strict=True)]
    holds, n_heavy = boxes.summed(lines, heavy.tolist()), int(heavy.sum())
    semantic = [k for k in range(len(boxes.tag)) if boxes.semantic[k] and 2 * share[k] > total and marks[k] == NEUTRAL]
    around = [k for k in range(len(boxes.tag)) if holds[k] == n_heavy and boxes.tag[k] not in PARTS and boxes.tag[k] not in ("html", "body") and not boxes.tag[k].startswith("~")]
    part = min(semantic) if semantic else max(around, default=-1)  # boxes are numbered as they open: the outermost, the innermost
    within, beside = [part < 0] * len(boxes.tag), [part < 0] * len(boxes.tag)
    for k, parent in enumerate(boxes.parent):
        if k == part or (parent >= 0 and within[parent]):
            within[k] = True
        beside[k] = within[k] and (k == part or parent < 0 or beside[parent]) and (k == part or holds[k] > 0 or boxes.tag[k] in ("html", "body"))
    kept = []
    for k, x in enumerate(lines):
        if off[k] or not (within[x.box] if x.box >= 0 else part < 0):
            continue
        if semantic or stretch[k]:
            kept.append(x.text)
        elif (x.box < 0 or beside[x.box]) and 2 * x.weight > len(x.text) and not (k > high and NOTICE.match(x.text)):
            kept.append(x.text)
    while not semantic and len(kept) > 1 and len(kept[-1]) <= 200 and NOTICE.match(kept[-1]):
        kept.pop()  # at the end of a page that doesn't say where its article ends
    return "\n\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([main_text(p) for p in batch.column(2).to_pylist()], pa.string())], ["page_id", "url", "text"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html")).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
