"""Main text of web pages by the maximum-scoring run of words and tags.

A page is read once as a sequence of chunks of text and tags. Each chunk has a *kind*: the outermost enclosing element that
is furniture (``footer``, ``div.ad``), else the nearest block (``p``). A word scores the weight of its kind, an opening tag
outside of furniture the weight of its name; a linear scan finds the contiguous run with the largest sum. The text of that run, without
its furniture, is the result.

An element is a candidate for furniture by its tag, its role, or a class or id that names such a part: one whose last word is such a
name (``site-header``), or its first and only fillers follow (``share-buttons``); words that say what a wrapper has or lacks (``with-sidebar``,
``no-share``, ``comments-enabled``) name nothing. A candidate is not furniture if its name was learned to wrap content, if it holds
ten times the words that lie in no candidate, or if it holds all ``article`` and ``main`` of the page and at least as many words as the
rest. ``nav``, ``footer`` and what is hidden always are.

Weights are learned from labelled pages, those that mark their content by ``article`` or ``main``: the log-odds of a
kind's words, and of a tag, to stand inside; and of a name, to hold most words of the marked content rather than some of it or of the rest. They come
from about ``sample`` of the marked pages drawn by a hash; kinds that were not met fall back on what their tag says. Every page is then
read whole, in time that grows with its length: what is open is looked up by name, never walked through.

End tags may be left out as HTML allows: a list item, table cell, row or part, term or option ends at the next one of its list or table, a paragraph at
a block, a head at the first tag or word that cannot stand in it, a title or button of which no end tag follows before
the next one ends at the next block.

Character references are decoded. A block or ``br`` ends a word, an inline tag does not; white space becomes one space.

Defined results: a null or empty page, or one without a positive run, has an empty text; of runs with equal sums the one that ends first counts,
begun as late as its sum allows; markup that is never closed ends with its parent; equal pages get equal texts; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 2000
TAG_SHARE = 0.25  # what a tag takes away at most, where a word gives 1 to 2
LINK = 1.0  # the same for a link
FURNITURE_WORD = -0.1  # at least; furniture is never written, so it need not part what lies on its two sides

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|[!?/][^>]*>|(?P<broken>[A-Za-z][^\s/>]*)[^>]*>)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|\Z)", re.I)
_RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "textarea", "select"}
_UNSEEN = _RAW | {"head", "title", "button", "audio", "video", "datalist", "dialog"}
_PLAIN = {"script", "style", "noscript", "iframe", "textarea"}  # what they hold is text up to their end tag, not markup
_IN_HEAD = {"html", "head", "base", "basefont", "bgsound", "link", "meta", "title", "script", "style", "noscript", "noframes",
            "template"}
_LOOSE = {"title", "button"}  # a block ends them if their end tag was left out
_FURNITURE = {"nav", "header", "footer", "aside", "form", "menu", "search"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "alert", "dialog"}
_NAMES = set(
    "ad ads advert adverts advertisement advertisements adbox adslot sponsor sponsored promo promotion sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs header masthead topbar footer cookie cookies consent notice notices banner popup"
    " modal overlay newsletter subscribe subscription signup login share sharing social related recommended"
    " recommendations comment comments disqus reply replies respond widget widgets toolbar pagination pager".split()
)
# what may follow such a name in a class or id without changing what it names
_FILLERS = set(
    "area bar block bottom box button buttons container content group holder icon icons inner item items left link links list"
    " outer panel posts right row section side slot top unit wrap wrapper zone".split()
)
# a class or id with one of these says what its element has or lacks, or what state it is in
_STATES = set("with without has have no not non enabled disabled free open closed on off is hide show supports using".split())
_MAIN = {"article", "main"}
_WHOLE = {"html", "body"} | _MAIN
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rp rt s samp small span strike strong sub sup"
    " time tt u var wbr img label".split()
)
_NAME_PART = re.compile(r"[a-z]+")
_ALWAYS = {"nav", "footer"}  # furniture whatever it holds; so are hidden elements and these roles
_ALWAYS_ROLES = {"navigation", "contentinfo", "alert", "dialog", "menu", "menubar"}
_SECTIONS = {"article", "section", "main", "nav", "aside", "header", "footer", "form", "body", "table", "td", "th", "blockquote", "figure"}
# start tag -> the open elements it ends, and those it does not look beyond
_ROWS = {"table", "body"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"} | _SECTIONS),
    "dt": ({"dt", "dd"}, {"dl"} | _SECTIONS),
    "dd": ({"dt", "dd"}, {"dl"} | _SECTIONS),
    "td": ({"td", "th"}, {"tr"} | _ROWS),
    "th": ({"td", "th"}, {"tr"} | _ROWS),
    "tr": ({"tr", "td", "th"}, _ROWS),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, _ROWS),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, _ROWS),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, _ROWS),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
WRAPPER = 10  # times the words that lie in no candidate make a candidate a wrapper of the content
LEAST_WORDS = 20  # that a wrapper has
LEARNED = 0.5  # weight from which a name is one of content


class Chunk(NamedTuple):
    what: str  # "text", "tag", or "end": a closing tag
    name: str  # of the tag, or of the nearest block around the text
    text: str
    candidate: int  # the innermost one around it, -1 for none
    inside: bool  # article or main


class Candidate(NamedTuple):
    kind: str
    outer: int  # the next candidate around it, -1 for none
    always: bool
    named: bool  # by class or id
    inside: bool  # article or main


class Page(NamedTuple):
    chunks: list[Chunk]
    candidates: list[Candidate]
    mains: list[int]  # of each article and main the innermost candidate around it


def _named_part(value: str) -> str:
    """The furniture name that a class or id gives its element; empty for none."""
    for token in value.lower().split():
        parts = _NAME_PART.findall(token)
        if _STATES.intersection(parts):
            continue
        for i, part in enumerate(parts):
            if part in _NAMES and all(p in _FILLERS or p in _NAMES for p in parts[i + 1 :]):
                return part
    return ""


def _furniture_kind(name: str, rest: str) -> tuple[str, bool, bool]:
    """(kind, always furniture, named by class or id) of a candidate; an empty kind for other elements."""
    kind, always, named = "", name in _ALWAYS, False
    if rest and name not in _WHOLE:
        for found in _ATTRIBUTE.finditer(rest):
            key = found[1].lower()
            value = (found[2] or found[3] or found[4] or "").lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                return f"{name}@hidden", True, False
            if key == "role" and value in _ROLES:
                kind, always = f"{name}@{value}", always or value in _ALWAYS_ROLES
            elif key in ("class", "id") and not kind and (part := _named_part(value)):
                kind, named = f"{name}.{part}", True
    if name in _FURNITURE:
        return name, always, False
    return kind, always, named and "@" not in kind


class _Open:
    """The open elements of a page. Everything asked of them takes the same time however many there are."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.blocks: list[int] = []  # depth of the nearest element that is not inline, itself included; -1 for none
        self.paragraphs: list[int] = []  # depth of a paragraph with only inline elements above it; -1 for none
        self.candidates: list[int] = []
        self.loose: list[bool] = []  # a block ends it
        self.places: dict[str, list[int]] = {}
        self.unseen = self.mains = 0  # open elements whose text is not shown; open article and main

    def push(self, name: str, candidate: int, loose: bool) -> None:
        at, inline = len(self.names), name in _INLINE
        self.blocks.append(at if not inline else self.blocks[-1] if at else -1)
        self.paragraphs.append(at if name == "p" else self.paragraphs[-1] if inline and at else -1)
        self.names.append(name)
        self.candidates.append(candidate)
        self.loose.append(loose)
        self.places.setdefault(name, []).append(at)
        self.unseen += name in _UNSEEN
        self.mains += name in _MAIN

    def cut(self, depth: int) -> None:
        """Close all from this depth on."""
        while len(self.names) > depth:
            name = self.names.pop()
            self.places[name].pop()
            self.unseen -= name in _UNSEEN
            self.mains -= name in _MAIN
            for column in (self.blocks, self.paragraphs, self.candidates, self.loose):
                column.pop()

    def last(self, name: str) -> int:
        places = self.places.get(name)
        return places[-1] if places else -1

    def candidate(self) -> int:
        return self.candidates[-1] if self.candidates else -1

    def block(self) -> str:
        return self.names[self.blocks[-1]] if self.names and self.blocks[-1] >= 0 else "body"

    def begin(self, name: str) -> None:
        """Close what the start tag of ``name`` ends because its own end tag was left out."""
        depth = self._unseen_ended_by(name) if self.unseen else -1
        if depth >= 0:
            self.cut(depth)
        if name in _ENDS:
            ended, within = _ENDS[name]
            wall = max(map(self.last, within))
            found = [d for d in map(self.last, ended) if d > wall]
            if found:
                # the outermost of them, say the row around a cell
                self.cut(min(found))
        if name not in _INLINE and self.paragraphs and self.paragraphs[-1] >= 0:
            self.cut(self.paragraphs[-1])

    def _unseen_ended_by(self, name: str) -> int:
        depth, at = -1, self.blocks[-1] if self.blocks else -1
        while at >= 0:
            if self.names[at] == "head":
                return depth if name in _IN_HEAD else at
            if not (self.loose[at] and (name == self.names[at] or name not in _INLINE | _IN_HEAD | _RAW | _VOID)):
                break
            depth, at = at, self.blocks[at - 1] if at else -1
        return depth


def parsed(page: str) -> Page:
    """The page as text and tags in order; scripts, styles, comments and what is never shown are left out."""
    chunks: list[Chunk] = []
    candidates: list[Candidate] = []
    mains: list[int] = []
    stack = _Open()
    at = 0
    last = page.rfind(">") + 1  # no tag ends behind it
    shown = page.find("<!--", last)
    end_of_page = len(page) if shown < 0 else shown  # a comment without an end hides the rest

    next_tag: dict[str, re.Match[str] | None] = {}

    def following(name: str) -> re.Match[str] | None:
        """The next start or end tag of ``name``; each is looked for once."""
        found = next_tag.get(name)
        if name not in next_tag or (found and found.start() < at):
            next_tag[name] = found = re.compile(rf"<(/?){name}(?=[\s/>])", re.I).search(page, at)
        return found

    endless: set[str] = set()  # elements without an end tag in the rest of the page

    def end_of(name: str) -> re.Match[str] | None:
        found = None if name in endless else re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at, last)
        if not found:
            endless.add(name)
        return found

    while at < len(page):
        found = _TAG.search(page, at, last) if at < last else None
        text = page[at : found.start() if found else end_of_page]
        if stack.names and stack.names[-1] == "head" and text.strip():
            stack.cut(len(stack.names) - 1)
        if text and not stack.unseen:
            chunks.append(Chunk("text", stack.block(), text, stack.candidate(), stack.mains > 0))
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["broken"] or "").lower()
        if not name:
            continue
        if found["close"]:
            depth = stack.last(name)
            if depth >= 0:
                stack.cut(depth)
            if not stack.unseen and name not in _INLINE:
                chunks.append(Chunk("end", name, "", stack.candidate(), stack.mains > 0))
            continue
        rest = found["rest"] or ""
        stack.begin(name)
        if not stack.unseen:
            chunks.append(Chunk("tag", name, "", stack.candidate(), stack.mains > 0))
        if name in _VOID or rest.endswith("/"):
            continue
        if name in _RAW and not stack.unseen:
            end = end_of(name)
            at = end.end() if end else len(page)
            continue
        if name in _PLAIN and (end := end_of(name)):
            at = end.end()
            continue
        candidate = stack.candidate()
        kind, always, named = _furniture_kind(name, rest)
        if kind and not stack.unseen:
            candidates.append(Candidate(kind, candidate, always, named, stack.mains > 0))
            candidate = len(candidates) - 1
        if name in _MAIN and not stack.unseen:
            mains.append(candidate)
        after = following(name) if name in _LOOSE else None
        stack.push(name, candidate, name in _LOOSE and not (after and after[1]))
    return Page(chunks, candidates, mains)


def _held(page: Page) -> tuple[list[int], list[int], list[int], int]:
    """Of each candidate: its words, those in no inner one, the mains in it; and the words that lie in no candidate."""
    own, mains = [0] * len(page.candidates), [0] * len(page.candidates)
    free = 0
    for chunk in page.chunks:
        if chunk.what == "text":
            n = len(chunk.text.split())
            if chunk.candidate < 0:
                free += n
            else:
                own[chunk.candidate] += n
    for candidate in page.mains:
        if candidate >= 0:
            mains[candidate] += 1
    words = own.copy()
    for i in range(len(words) - 1, -1, -1):  # inner ones come later
        outer = page.candidates[i].outer
        if outer >= 0:
            words[outer] += words[i]
            mains[outer] += mains[i]
    return words, own, mains, free


def furniture(page: Page, weights: Weights) -> list[str]:
    """The outermost furniture around each candidate, itself included, by its kind; empty for none."""
    words, own, mains, free = _held(page)
    content = [not c.always and c.named and weights.words.get(c.kind, 0.0) > LEARNED for c in page.candidates]
    inner: dict[int, list[int]] = {}
    for i, c in enumerate(page.candidates):
        inner.setdefault(c.outer, []).append(i)
    waiting: list[tuple[int, int]] = []  # candidates around which all is content, the one with most words first

    def open_up(around: int) -> None:
        nonlocal free
        opened = [around]
        while opened:
            for i in inner.get(opened.pop(), []):
                if content[i]:
                    free += own[i]
                    opened.append(i)
                elif not page.candidates[i].always:
                    heapq.heappush(waiting, (-words[i], i))

    open_up(-1)
    while waiting:
        size, i = heapq.heappop(waiting)
        marked = page.mains and mains[i] == len(page.mains) and -size >= free
        if -size < LEAST_WORDS or not (marked or -size > WRAPPER * free):
            continue
        content[i] = True
        free += own[i]
        open_up(i)
    out: list[str] = []
    for i, c in enumerate(page.candidates):
        around = out[c.outer] if c.outer >= 0 else ""
        out.append(around or ("" if content[i] else c.kind))
    return out


class Weights:
    """Scores of words by kind and of tags by name."""

    def __init__(self, words: dict[str, float] | None = None, tags: dict[str, float] | None = None) -> None:
        self.words, self.tags = words or {}, tags or {}

    def word(self, kind: str) -> float:
        if _furniture(kind):
            return max(FURNITURE_WORD, min(0.0, self.words.get(kind, FURNITURE_WORD)))
        return self.words.get(kind, 1.0)

    def tag(self, name: str) -> float:
        return self.tags.get(name, -LINK if name == "a" else 0.0 if name in _INLINE or name == "br" else -TAG_SHARE)


def _furniture(kind: str) -> bool:
    return kind in _FURNITURE or "." in kind or "@" in kind


def _count(text: str) -> Counter[tuple[str, str, bool]]:
    """Words by kind and tags by name, inside and outside of the marked content; nothing for an unmarked page.

    Words of a name stand inside if it holds most words of the marked content, or all of that and little else.
    """
    page = parsed(text)
    seen: Counter[tuple[str, str, bool]] = Counter()
    if not page.mains:
        return seen
    around = furniture(page, Weights())
    marked = 0
    for chunk in page.chunks:
        kind = around[chunk.candidate] if chunk.candidate >= 0 else ""
        if chunk.what == "text":
            n = len(chunk.text.split())
            marked += n * chunk.inside
            if "." not in kind:
                seen["text", kind or chunk.name, chunk.inside] += n
        elif chunk.what == "tag" and not kind:
            seen["tag", chunk.name, chunk.inside] += 1
    words, _, mains, _ = _held(page)
    for i, c in enumerate(page.candidates):
        if c.named:
            holds = 2 * words[i] > marked if c.inside else mains[i] == len(page.mains) and words[i] < 2 * marked
            seen["name", c.kind, holds] += words[i]
    return seen


def learned(totals: dict[tuple[str, str, bool], int]) -> Weights:
    """Weights from counts of (what, kind, inside)."""
    words: dict[str, float] = {}
    tags: dict[str, float] = {}
    for what, kind in {(w, k) for w, k, _ in totals}:
        within, without = totals.get((what, kind, True), 0), totals.get((what, kind, False), 0)
        if what == "name":
            words[kind] = max(-2.0, min(2.0, math.log((within + 0.5) / (without + 10.5))))
        elif what == "text":
            default = Weights().word(kind)
            odds = math.log((within + 10 * (default > 0) + 0.5) / (without + 10 * (default < 0) + 0.5))
            words[kind] = max(FURNITURE_WORD, min(0.0, odds)) if _furniture(kind) else max(-2.0, min(2.0, odds))
        else:
            odds = math.log((within + 5) / (without + 5))
            least = -LINK if kind == "a" else -TAG_SHARE
            tags[kind] = max(least, min(0.0, 0.1 * odds + Weights().tag(kind) / 2))
    return Weights(words, tags)


def fit(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from about ``sample`` of the marked pages, drawn by a hash; only sums by kind reach the driver."""
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    share = min(1.0, sample / max(marked.count(), 1))
    mark = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40))
    drawn = marked.where(mark < F.lit(math.ceil(share * (1 << 40))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, str, bool]] = Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                total.update(_count(page))
        keys = list(zip(*total)) or [()] * 3
        kinds = [pa.string(), pa.string(), pa.bool_()]
        columns = [*(pa.array(k, t) for k, t in zip(keys, kinds)), pa.array(total.values(), pa.int64())]
        yield pa.record_batch(columns, names=["what", "kind", "inside", "n"])

    counted = drawn.select("html").mapInArrow(rows, "what string, kind string, inside boolean, n bigint")
    sums = counted.groupBy("what", "kind", "inside").agg(F.sum("n").alias("n")).collect()
    return learned({(r["what"], r["kind"], r["inside"]): r["n"] for r in sums})


def main_text(page: str | None, weights: Weights) -> str:
    """The text of the best run of one page."""
    read = parsed(page or "")
    around = furniture(read, weights)
    parts: list[tuple[float, str]] = []  # score, text as it will be written
    for what, name, text, candidate, _ in read.chunks:
        kind = around[candidate] if candidate >= 0 else ""
        if what != "text":
            parts.append((weights.tag(name) if what == "tag" and not kind else 0.0, "" if name in _INLINE else " "))
        elif kind:
            parts.append((weights.word(kind) * len(text.split()), ""))
        else:
            parts.append((weights.word(name) * len(text.split()), html.unescape(text)))
    best = total = 0.0
    start, found = 0, (0, 0)
    for i, (score, _) in enumerate(parts):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return " ".join("".join(text for _, text in parts[slice(*found)]).split())


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) for page in batch.column(2).to_pylist()]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths]
            yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    rows_of = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows_of.mapInArrow(rows, "page_id bigint, url string, text string, n_chars bigint")
