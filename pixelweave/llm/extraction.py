"""Main text of web pages by a maximum-scoring subsequence (operator 11).

A page is a sequence of tags and words. Words score positive and tags negative, and a linear scan
finds the contiguous region with the highest sum. The scores are log-likelihood ratios of a
token inside against outside the main text, counted on the labelled pages: those that mark
their main text with exactly one ``article`` (or, without one, one ``main``) element. Tags get the
negative part of their ratio, words at least ``LEAST_WORD``; pseudo-counts of a prior make a
table without labelled pages work too.

Elements that are no main text by name, role, class or id (menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles, reader comments) score no words and are left out of the region's
text. A class does not remove an element that holds the title or the main element, nor, unless it
names comments, more than half of the page's words; a header inside the main element is the
article's own. Where most of the region's words lie in one main element, the region is the whole
of it; otherwise it consists of the blocks that it touches.

Text of a block has its character references decoded, its white space turned into single
blanks and is trimmed; blocks are joined by an empty line. Line breaks and table cells are
white space, rows of tables are blocks.

Defined cases: null and empty pages, and pages without words, have the text ''; equal regions: the
first; repeated rows are extracted each; null keys and urls stay null; an empty table gives an empty
result; extra columns pass through, and those named ``text`` or ``n_chars`` are replaced; markup of any
length is read whole and once; what is never closed ends with the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pixelweave.llm.text import texts

# Names of elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody tfoot thead tr ul".split()
)
CELL = frozenset("td th br".split())
# An open paragraph ends before these.
ENDS_P = BLOCK - frozenset("body caption head html legend tbody tfoot thead tr".split())
# What an element closes when it opens, up to the element that holds the list.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
MAIN = frozenset(["article", "main"])
# No main text by name, by role, and by the words of class and id.
DROPPED = frozenset(
    "head nav aside footer form script style noscript template iframe button select textarea title svg math "
    "canvas audio video object dialog datalist menu search input label noembed noframes xmp".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox adunit sponsor sponsored "
    "sponsors promo promos promoted promotion cookie cookies consent gdpr notice notices notification popup modal "
    "overlay toast banner newsletter subscribe subscription sidebar sidebars rail widget widgets related recommended "
    "recommendations trending share sharing social breadcrumb breadcrumbs pagination pager nav navbar navigation menu "
    "menus topbar toolbar masthead footer login signup skip copyright disclaimer outbrain taboola".split()
)
HEADER_WORDS = frozenset(["header"])
COMMENT_WORDS = re.compile(r"comment(s|list|ary)?|disqus|respond|replies|reply|discussion")

# Least score of a word, greatest of a tag; what it counts for.
LEAST_WORD, MOST_TAG = 0.05, -0.01
# Pseudo-counts of words, of tags that running text has and of other tags: inside and outside the
# main text.
PRIOR_WORDS, PRIOR_TEXT, PRIOR_TAG = (400.0, 200.0), (4.0, 4.0), (1.0, 4.0)
TEXT_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 br b i em strong u s q cite code pre blockquote sub sup mark small span figcaption "
    "table tbody thead tr td th".split()
)
WORDS = "words"

_TAG = re.compile(
    r"<(?:(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|)|[\"'])*+)>?|(!--)|[!?/][^>]*+>?)"
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
_KNOWN = BLOCK | CELL | VOID | DROPPED | frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var picture map progress meter output slot colgroup".split()
)


@dataclass
class _Part:
    """An element that may be left out, or a main element: its place among the segments."""

    kind: str
    first: int
    end: int = -1
    has_main: bool = False


@dataclass
class Page:
    """Segments of text with the block each belongs to, tags between them, and marked elements."""

    segments: list[str] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    # Kind of tag, or the place of a segment.
    items: list[str | int] = field(default_factory=list)
    parts: list[_Part] = field(default_factory=list)
    mains: list[_Part] = field(default_factory=list)


def _kind(name: str, attributes: str, in_main: bool) -> str | None:
    """Why an element may be left out: 'name', 'class' or 'comments'."""
    if name in DROPPED or (name == "header" and not in_main):
        return "name"
    if not attributes or name in ("html", "body", "main"):
        return None
    words: set[str] = set()
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = next(filter(None, values), "")
        key = key.lower()
        if key == "hidden" or (key == "style" and _HIDDEN.search(value)):
            return "class"
        if key == "role" and value.strip().lower() in DROPPED_ROLES:
            return "class"
        if key in ("class", "id"):
            words.update(map(str.lower, _NAME_WORD.findall(value)))
    if any(map(COMMENT_WORDS.fullmatch, words)):
        return "comments"
    if name != "article" and (words & DROPPED_WORDS or (words & HEADER_WORDS and not in_main)):
        return "class"
    return None


def parse(source: str) -> Page:
    """Read a page once, from left to right."""
    page = Page()
    segments, blocks, items = page.segments, page.blocks, page.items
    # Open elements, from the outermost: name and part; and how many of each name.
    stack: list[tuple[str, _Part | None]] = []
    is_open: Counter[str] = Counter()
    mains_open = block = at = 0
    search, size = _TAG.search, len(source)

    def add(text: str) -> None:
        if text:
            items.append(len(segments))
            segments.append(text)
            blocks.append(block)

    def close(i: int) -> None:
        """End the open element at place ``i`` of the stack."""
        nonlocal mains_open
        name, part = stack.pop(i)
        is_open[name] -= 1
        mains_open -= name in MAIN
        if part is not None:
            part.end = len(segments)

    def close_down_to(i: int) -> None:
        while len(stack) > i:
            close(len(stack) - 1)

    def close_last(names: set[str], within: frozenset | set) -> None:
        """End the innermost of some elements, unless one of ``within`` is further in."""
        if any(is_open[n] for n in names):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in names:
                    close_down_to(i)
                    # A row ends its last cell and the row before.
                    return close_last(names, within)
                if stack[i][0] in within:
                    return

    while (tag := search(source, at)) is not None:
        add(source[at : tag.start()])
        at = tag.end()
        closing, name, attributes, comment = tag.groups()
        if comment:
            end = source.find("-->", at)
            # "<!-->" and "<!--->" are comments, too.
            at = source.index(">", at) + 1 if source.startswith((">", "->"), at) else size if end < 0 else end + 3
            continue
        if name is None:
            continue
        name = name.lower()
        is_block = name in BLOCK
        block += is_block
        if name in CELL:
            add(" ")
        items.append(("/" if closing else "") + (name if name in _KNOWN else "other"))
        if closing:
            if is_open[name]:
                i = len(stack) - 1
                while stack[i][0] != name:
                    i -= 1
                # The end of an inline element leaves the blocks in it open.
                if is_block or name in CELL or name in DROPPED:
                    close_down_to(i)
                else:
                    close(i)
            continue
        if name in ENDS_P and is_open["p"]:
            close_last({"p"}, {"button", "td", "th", "caption", "table", "object"})
        if name in CLOSES:
            close_last(*CLOSES[name])
        if name in VOID or attributes.endswith("/") and name in ("svg", "math", "path"):
            continue
        part = None
        kind = _kind(name, attributes, mains_open > 0)
        if kind:
            part = _Part(kind, len(segments))
            page.parts.append(part)
        elif name in MAIN:
            part = _Part(name, len(segments))
            page.mains.append(part)
        if kind is None and (name in MAIN or name == "h1"):
            for _, outer in stack:
                if outer is not None:
                    outer.has_main = True
        if name in RAW:
            # Nothing but its own end tag ends it.
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            stop = end.start() if end else size
            add(source[at:stop])
            at = stop
        stack.append((name, part))
        is_open[name] += 1
        mains_open += name in MAIN
    add(source[at:])
    close_down_to(0)
    return page


def _words(page: Page) -> np.ndarray:
    """Words of every segment."""
    return np.array([len(html.unescape(s).split()) if "&" in s else len(s.split()) for s in page.segments], np.int64)


def _kept(page: Page, words: np.ndarray) -> np.ndarray:
    """Which segments may be main text."""
    keep = np.ones(len(words), bool)
    for part in page.parts:
        if part.kind == "name":
            keep[part.first : part.end] = False
    upto = np.r_[0, np.cumsum(words * keep)]
    for part in page.parts:
        holds = upto[part.end] - upto[part.first]
        if part.kind == "comments" and not part.has_main:
            keep[part.first : part.end] = False
        elif part.kind == "class" and not part.has_main and 2 * holds <= upto[-1]:
            keep[part.first : part.end] = False
    return keep


def _main_of(page: Page, keep: np.ndarray) -> _Part | None:
    """The one element that marks the main text."""
    for name in ("article", "main"):
        found = [m for m in page.mains if m.kind == name and keep[m.first : m.end].any()]
        if len(found) == 1:
            return found[0]
        if found:
            return None
    return None


def best_region(scores: np.ndarray) -> tuple[int, int]:
    """First and end of the contiguous region with the highest sum; empty if none is positive."""
    upto = np.r_[0.0, np.cumsum(scores)]
    lowest = np.minimum.accumulate(upto)
    end = int(np.argmax(upto - lowest))
    if upto[end] <= lowest[end]:
        return 0, 0
    return int(np.flatnonzero(upto[: end + 1] == lowest[end])[-1]), end


def _container(page: Page, words: np.ndarray) -> _Part | None:
    """The main element that holds most of the words; of nested ones the outermost article."""
    for name in ("article", "main"):
        for main in page.mains:
            if main.kind == name and 2 * words[main.first : main.end].sum() > words.sum():
                return main
    return None


def block_texts(page: Page, keep: np.ndarray) -> list[str]:
    """Texts of the blocks from the kept segments."""
    parts: dict[int, list[str]] = {}
    for i in np.flatnonzero(keep).tolist():
        parts.setdefault(page.blocks[i], []).append(page.segments[i])
    found = (" ".join(html.unescape("".join(p)).split()) for p in parts.values())
    return [t for t in found if t]


def extract(source: str, scores: dict[str, float]) -> str:
    """Main text of a page by the scores of ``learn``."""
    page = parse(source)
    words = _words(page)
    keep = _kept(page, words)
    gain = scores[WORDS] * (words * keep)
    line = np.array([gain[x] if isinstance(x, int) else scores[x] for x in page.items])
    first, end = best_region(line)
    region = np.zeros(len(words), bool)
    region[[x for x in page.items[first:end] if isinstance(x, int)]] = True
    region &= keep
    container = _container(page, words * region)
    if container is not None:
        region[container.first : container.end] = True
        region[: container.first] = region[container.end :] = False
    else:
        blocks = np.array(page.blocks)
        region |= np.isin(blocks, blocks[region & (words > 0)])
    return "\n\n".join(block_texts(page, region & keep))


_COUNTED = StructType([StructField("kind", StringType()), StructField("inside", LongType()),
                       StructField("outside", LongType())])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens by kind inside and outside the main text of the labelled pages."""
    inside: Counter[str] = Counter()
    everywhere: Counter[str] = Counter()
    for batch in batches:
        for source in texts(batch.column(0)):
            page = parse(source)
            words = _words(page)
            keep = _kept(page, words)
            main = _main_of(page, keep)
            if main is None:
                continue
            within = np.zeros(len(words), bool)
            within[main.first : main.end] = keep[main.first : main.end]
            everywhere[WORDS] += int(words.sum())
            inside[WORDS] += int(words[within].sum())
            # Tags between two segments of the main text are inside it.
            before, between = False, []
            for item in page.items:
                if not isinstance(item, int):
                    everywhere[item] += 1
                    between.append(item)
                elif words[item]:
                    if before and within[item]:
                        inside.update(between)
                    before, between = within[item], []
    kinds = sorted(everywhere)
    yield pa.RecordBatch.from_arrays([
        pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
        pa.array([everywhere[k] - inside[k] for k in kinds], pa.int64()),
    ], _COUNTED.names)


def scores_of(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Score of words and of every kind of tag from their counts inside and outside."""
    kinds = [WORDS, "other", "/other", *_KNOWN, *("/" + k for k in _KNOWN)]
    held = {}
    for kind in kinds:
        of_text = kind.removeprefix("/") in TEXT_TAGS
        prior = PRIOR_WORDS if kind == WORDS else PRIOR_TEXT if of_text else PRIOR_TAG
        held[kind] = [n + p for n, p in zip(counts.get(kind, (0, 0)), prior)]
    n_in, n_out = (sum(h[i] for h in held.values()) for i in (0, 1))
    ratio = {k: math.log(h[0] / n_in) - math.log(h[1] / n_out) for k, h in held.items()}
    return {k: max(r, LEAST_WORD) if k == WORDS else min(r, MOST_TAG) for k, r in ratio.items()}


def learn(pages: DataFrame, source: str = "html") -> dict[str, float]:
    """Scores from all labelled pages of a table."""
    # One row per kind of token; names that are no HTML count as one.
    counted = pages.select(source).mapInArrow(_counts, _COUNTED).groupBy("kind")
    rows = counted.agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return scores_of({r["kind"]: (r["inside"], r["outside"]) for r in rows})


def main_text(scores: dict[str, float], source: Column) -> Column:
    """Main text of a page."""

    @arrow_udf(StringType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([extract(t, scores) for t in texts(batch)], pa.string())

    return of(source)


def extracted(pages: DataFrame, source: str = "html", scores: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with their main ``text`` and its length ``n_chars`` in code points."""
    scores = learn(pages, source) if scores is None else scores
    found = pages.withColumn("text", main_text(scores, F.col(source)))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
