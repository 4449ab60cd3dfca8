"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is read into text blocks in page order. A linear classifier gives each block the log odds of being content, from
its length, link share, punctuation, whether it is a heading, and the nearest mark above it: an element such as <nav> or
<article>, or a class, id or role word. The odds become the capacity of the block's edge to the source or the sink;
blocks that follow each other and blocks whose elements have one parent are tied by smoothness edges of the same scale.
The minimum cut, found by max-flow, separates content from boilerplate with the least total cost. Blocks whose odds
exceed all their ties keep their side in every minimum cut and are taken out first, so the flow runs on what is left.

A class, id or role word is weak evidence: where an element that has no more than such a word against it holds nearly all
prose of a page, in several paragraphs, the word is taken for a topic (`share-price`, `privacy`) and has no weight.
Words of reader comments and consent always count.

The weights are the prior ones below. They can also be fitted to the pages (`fit`): on a bounded sample of them, link
lists, hidden texts and texts that several pages share are taken as boilerplate, long unmarked texts of one page as
content; logistic loss, with a pull to the prior, moves the weights.

Defined cases: null and empty pages and pages without content give an empty text; unclosed and stray tags are
tolerated; ids, repeated rows and other columns do not matter. Each page is one row's work, in one pass.
"""

from __future__ import annotations

import html
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._arrow import texts
from ._learn import sigmoid
from ._spark import small_batches

# Element names of HTML and the words of class and id attributes that mark boilerplate or content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
#: Elements whose text is not shown, read as a subtree up to their end tag; without one they hide nothing.
VEILED = frozenset("noscript template svg math object canvas audio video".split())
#: Elements that hold the page or its main text; no word marks all of that as boilerplate.
WHOLE = frozenset("html body main article".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody"
    " td tfoot th thead tr ul".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog button select fieldset label legend".split())
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSED_BY_SAME = frozenset("li dt dd option tr td th".split())
CONTENT_WORDS = frozenset("article content post entry story main text body prose".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright"
    " disclaimer discussion dialog footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay"
    " pager pagination popup privacy promo promoted promotion promotions recommended related replies reply respond search share sharing"
    " sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets alert complementary"
    " contentinfo banner alertdialog".split()
)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S)
_HINT = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_UNQUOTED_SLASH = re.compile(r"""=\s*[^\s"']+/\Z""")
_HEADING = re.compile("h[1-6]")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+(?![a-z])")

#: Of the boilerplate words, those that mean it also as a part of a longer name, such as comment-list.
STRONG_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs byline comment comments consent cookie cookies footer gdpr menu modal nav navbar"
    " navigation newsletter notice notices pagination popup promo promoted promotion promotions sidebar signup sponsor sponsored subscribe subscription"
    " toolbar topbar".split()
)
#: Words that count against an element however much prose it holds.
FIRM_WORDS = frozenset("comment comments discussion reply replies respond consent cookie cookies gdpr".split())
#: A text of so many characters and so small a share of links is prose; what an element must hold to be doubted.
PROSE, LINKED, DOUBT_CHARS, DOUBT_TIMES = 120, 0.2, 600, 3
#: Log odds of the marks of elements and words.
IN_BOILERPLATE, IN_CONTENT, HIDDEN, STRONG, PLAIN, PARTIAL, CONTENT_WORD = -4.0, 1.5, -9.0, -4.0, -3.0, -1.0, 0.8
#: Prior weights: constant, length, link share, punctuation, heading, mark. Ties of neighbours and of siblings.
PRIOR = (-1.6, 2.2, -3.0, 0.5, 0.8, 1.0)
NEIGHBOUR, SIBLING = 0.5, 1.5
#: Log odds are cut here, so that no block outweighs a whole page.
MOST = 6.0
#: Pages and blocks of the sample that the weights are fitted to, and how strongly the prior pulls.
SAMPLE_PAGES, SAMPLE_BLOCKS, PULL = 2000, 50_000, 0.6


def _mark(name: str, attributes: str) -> float:
    """What an element and its class, id and role say of its text; 0 is nothing."""
    if attributes and _HIDDEN.search(attributes):
        return HIDDEN
    if name in BOILERPLATE:
        return IN_BOILERPLATE
    if name in ("article", "main"):
        return IN_CONTENT
    if not attributes or name in WHOLE:
        return 0.0
    out = 0.0
    for _, v in _HINT.findall(attributes):
        for part in v.strip("\"'").split():
            words = {w.lower() for w in _WORD.findall(part)}
            if words & CONTENT_WORDS:
                return CONTENT_WORD if out == 0 and not words & BOILERPLATE_WORDS else 0.0
            if words & STRONG_WORDS:
                out = min(out, STRONG)
            elif words & BOILERPLATE_WORDS:
                out = min(out, PLAIN if len(words) == 1 else PARTIAL)
    return out


def _by_word(name: str, attributes: str) -> bool:
    """Whether nothing but a class, id or role word marks an element as boilerplate, and none that is firm."""
    if name in BOILERPLATE or _HIDDEN.search(attributes):
        return False
    words = {w.lower() for _, v in _HINT.findall(attributes) for w in _WORD.findall(v)}
    return not words & FIRM_WORDS


def _closed(attributes: str) -> bool:
    """Whether a tag ends in a slash that is no part of an unquoted value."""
    attributes = attributes.rstrip()
    return attributes.endswith("/") and not _UNQUOTED_SLASH.search(attributes)


class _Block:
    __slots__ = ("text", "share", "mark", "parent", "name", "word")

    def __init__(self, text: str, share: float, mark: float, parent: int, name: str, word: int):
        self.text, self.share, self.mark, self.parent, self.name, self.word = text, share, mark, parent, name, word

    def features(self) -> tuple[float, ...]:
        n = len(self.text)
        stops = sum([self.text.count(c) for c in ".!?\u2026\u3002"])
        return 1.0, min(math.log1p(n) / 5.3, 1.3), self.share, min(stops * 100 / max(n, 1), 1.0), float(_HEADING.fullmatch(self.name) is not None), self.mark


def odds(features: tuple[float, ...], weights: tuple[float, ...]) -> float:
    return max(-MOST, min(MOST, sum([x * w for x, w in zip(features, weights)])))


def read_blocks(page: str) -> list[_Block]:
    """The text blocks of a page, with the nearest mark above each and the parent of its element."""
    blocks: list[_Block] = []
    # Open elements: name, nearest mark, number of the nearest block element, whether in a link, that element's parent, and
    # number of the element whose word alone gives the mark, or 0.
    stack: list[tuple[str, float, int, bool, int, int]] = [("", 0.0, 0, False, 0, 0)]
    marked = 0
    parts: list[tuple[str, bool]] = []
    number, at, n = 0, 0, len(page)
    veil = 0  # place in the stack of the outermost veiled element
    ends: dict[str, int] = {}  # where the last end tag of a name begins

    def ends_later(name: str) -> bool:
        if name not in ends:
            ends[name] = max([m.start() for m in re.finditer(rf"</{name}\s*>", page, re.I)], default=-1)
        return ends[name] >= at

    def flush() -> None:
        if parts:
            raw = "".join([p for p, _ in parts])
            text = " ".join(html.unescape(raw).split())
            if text:
                linked = sum([len(p) for p, in_link in parts if in_link])
                name, mark, _, _, parent, word = stack[-1]
                blocks.append(_Block(text, linked / max(len(raw), 1), mark, parent, name, word))
            parts.clear()

    while at < n:
        found = _TAG.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text and not veil:
            parts.append((text, stack[-1][3]))
        if not found:
            break
        at = found.end()
        closing, name, attributes = found[1], found[2], found[3]
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in BLOCK and not veil:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    if not 0 < veil <= k and (any(stack[j][0] in BLOCK for j in range(k, len(stack))) or stack[k][1] != stack[k - 1][1]):
                        flush()
                    del stack[k:]
                    veil = veil if veil < k else 0
                    break
                if name not in BLOCK and name not in VEILED and stack[k][0] in BLOCK:
                    break  # an inline end tag closes nothing outside its block
            continue
        if name in RAW:
            if not _closed(attributes):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            parts.append((" ", False))
            continue
        if name == "head" and not veil:
            end = None if _closed(attributes) else re.compile(r"</head\s*>", re.I).search(page, at)
            at = end.end() if end else at
            parts.append((" ", False))
            continue
        if name in VEILED:
            parts.append((" ", False))
            if not _closed(attributes) and ends_later(name):
                veil = veil or len(stack)
                stack.append((name, *stack[-1][1:]))
            continue
        if veil:
            if name not in VOID and not attributes.rstrip().endswith("/"):
                stack.append((name, *stack[-1][1:]))
            continue
        if name in VOID:
            flush() if name == "hr" else parts.append((" ", stack[-1][3]))
            continue
        block = name in BLOCK
        mark = _mark(name, attributes)
        if block or mark < 0:
            flush()
        if block:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in CLOSED_BY_BLOCK or stack[k][0] == name and name in CLOSED_BY_SAME:
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK:
                    break
            number += 1
        up = stack[-1]
        # A mark holds until a nearer one; within hidden or marked text, content words and elements change nothing.
        own = mark < up[1] if up[1] <= PLAIN else mark != 0
        if own and mark < 0 and _by_word(name, attributes):
            marked += 1
            word = marked
        else:
            word = 0 if own else up[5]
        mark = min(mark, up[1]) if up[1] <= PLAIN else mark or up[1]
        if not attributes.rstrip().endswith("/"):
            stack.append((name, mark, number if block else up[2], up[3] or name == "a", up[2] if block else up[4], word))
    flush()
    if marked:
        _doubt_words(blocks)
    return blocks


def _doubt_words(blocks: list[_Block]) -> None:
    """Take the mark off the blocks of an element that a word alone marks, if it holds nearly all that could be content.

    It must have DOUBT_CHARS characters of prose in two blocks or more, and DOUBT_TIMES as many as all texts outside
    it that nothing marks as boilerplate, and as all prose that other such elements hold.
    """
    held: dict[int, list[int]] = {}
    free = 0
    for b in blocks:
        prose = len(b.text) >= PROSE and b.share < LINKED
        if b.word and prose:
            held.setdefault(b.word, []).append(len(b.text))
        elif not b.word and b.mark >= 0 and b.share < LINKED:
            free += len(b.text)
    total = sum([sum(sizes) for sizes in held.values()])
    for word, sizes in held.items():
        mine = sum(sizes)
        if len(sizes) > 1 and mine >= DOUBT_CHARS and mine >= DOUBT_TIMES * (free + total - mine):
            for b in blocks:
                if b.word == word:
                    b.mark = 0.0


def _ties(blocks: list[_Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges; a change of the mark between two blocks makes a boundary there cheap."""
    out = [(i, i + 1, NEIGHBOUR) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if b.parent in last:
            out.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    return [(i, j, c * math.exp(-abs(blocks[i].mark - blocks[j].mark))) for i, j, c in out]


def minimum_cut(score: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it is on the content side of a minimum cut."""
    n = len(score)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, c in ties:
        near[a].append((b, c))
        near[b].append((a, c))
    score = list(score)
    side: list[bool | None] = [None] * n
    free = [sum([c for _, c in x]) for x in near]
    queue = list(range(n))
    while queue:  # blocks that lean more than all their ties
        i = queue.pop()
        if side[i] is None and abs(score[i]) > free[i]:
            side[i] = score[i] > 0
            for j, c in near[i]:
                if side[j] is None:
                    score[j] += c if side[i] else -c
                    free[j] -= c
                    queue.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        at = {i: k for k, i in enumerate(rest)}
        flow = _MaxFlow(len(rest) + 2)
        source, sink = len(rest), len(rest) + 1
        for i in rest:
            if score[i] > 0:
                flow.edge(source, at[i], score[i], 0.0)
            elif score[i] < 0:
                flow.edge(at[i], sink, -score[i], 0.0)
        for a, b, c in ties:
            if a in at and b in at:
                flow.edge(at[a], at[b], c, c)
        reach = flow.run(source, sink)
        for i in rest:
            side[i] = at[i] in reach
    return [bool(x) for x in side]


class _MaxFlow:
    """Shortest augmenting paths in levels."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float) -> None:
        for x, y, c in ((a, b, there), (b, a, back)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.left.append(c)

    def run(self, source: int, sink: int) -> dict[int, int]:
        """The nodes that the source still reaches when the flow is largest, with their levels."""
        while True:
            level, order = {source: 0}, [source]
            for x in order:
                for e in self.out[x]:
                    if self.left[e] > 1e-9 and self.to[e] not in level:
                        level[self.to[e]] = level[x] + 1
                        order.append(self.to[e])
            if sink not in level:
                return level
            tried = [0] * len(self.out)
            path: list[int] = []
            x = source
            while True:
                if x == sink:
                    least = min(self.left[e] for e in path)
                    for e in path:
                        self.left[e] -= least
                        self.left[e ^ 1] += least
                    x, path = source, []
                while tried[x] < len(self.out[x]):
                    e = self.out[x][tried[x]]
                    if self.left[e] > 1e-9 and level.get(self.to[e]) == level[x] + 1:
                        break
                    tried[x] += 1
                else:
                    if x == source:
                        break
                    x = self.to[path.pop() ^ 1]
                    tried[x] += 1
                    continue
                path.append(e)
                x = self.to[e]


def label(blocks: list[_Block], weights: tuple[float, ...] = PRIOR) -> tuple[list[float], list[bool]]:
    """For each block its log odds, and whether it is content."""
    scores = [odds(b.features(), weights) for b in blocks]
    return scores, minimum_cut(scores, _ties(blocks))


def main_text(page: str | None, weights: tuple[float, ...] = PRIOR) -> str:
    if not page:
        return ""
    blocks = read_blocks(page)
    return "\n\n".join([b.text for b, k in zip(blocks, label(blocks, weights)[1]) if k])


def fit(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE_PAGES) -> tuple[float, ...]:
    """Weights of the classifier, from at most `sample` pages, the first by a hash of the page.

    At most SAMPLE_BLOCKS of their blocks reach the driver, as six numbers and a hash each.
    """
    keyed = pages.select(F.xxhash64(html_col).alias("h"), F.col(html_col).alias("html")).where("html is not null")
    first = keyed.select("h").orderBy("h").limit(sample).distinct()
    some = keyed.join(F.broadcast(first), "h").dropDuplicates(["h"])

    def blocks(batches):
        for b in batches:
            for page in texts(b.column(0)):
                found = read_blocks(page)
                if found:
                    codes = [zlib.crc32(x.text.encode("utf-8", "surrogatepass")) for x in found]
                    yield pa.RecordBatch.from_arrays([pa.array([list(x.features()) for x in found], pa.list_(pa.float64())), pa.array(codes, pa.int64())], names=["x", "code"])

    rows = some.select("html").mapInArrow(blocks, "x array<double>, code long")
    rows = rows.groupBy("x", "code").agg(F.count("*").alias("n")).orderBy(F.xxhash64("code", "x"), "code").limit(SAMPLE_BLOCKS).collect()
    if not rows:
        return PRIOR
    x, n = np.array([r["x"] for r in rows]), np.array([r["n"] for r in rows], float)
    chars = np.expm1(x[:, 1] * 5.3)
    bad = (x[:, 2] > 0.5) | (n > 1) | (x[:, 5] <= HIDDEN)
    good = ~bad & (chars >= 160) & (x[:, 2] < 0.2) & (x[:, 5] >= 0)
    prior = np.array(PRIOR)
    if not good.any() or not bad.any():
        return PRIOR
    w, y = prior.copy(), good.astype(float)
    side = np.where(good, 0.5 / good.sum(), np.where(bad, 0.5 / bad.sum(), 0))
    for _ in range(500):
        w -= 0.5 * (x.T @ ((sigmoid(x @ w) - y) * side) + PULL * (w - prior))
    return tuple(float(v) for v in w)


def decided_by_cut(pages: DataFrame, weights: tuple[float, ...], html_col: str = "html") -> DataFrame:
    """One row: the number of blocks, and of those whose side is not the one that their own odds ask for."""

    def count(batches):
        for b in batches:
            total = turned = 0
            for page in texts(b.column(0)):
                scores, sides = label(read_blocks(page or ""), weights)
                total += len(scores)
                turned += sum([(s > 0) != k for s, k in zip(scores, sides)])
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([turned])], names=["blocks", "turned"])

    rows = pages.select(F.col(html_col)).mapInArrow(count, "blocks long, turned long")
    return rows.agg(F.sum("blocks").alias("blocks"), F.sum("turned").alias("turned"))


def extract_text(pages: DataFrame, keep: tuple[str, ...] | None = None, html_col: str = "html", weights: tuple[float, ...] = PRIOR) -> DataFrame:
    """The columns `keep` (all but the html by default) of `pages`, the main text and its number of characters."""
    keep = tuple(c for c in pages.columns if c != html_col and c not in ("text", "n_chars")) if keep is None else keep
    small_batches(pages.sparkSession)
    names = [*keep, "text", "n_chars"]

    def scan(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                some = b.slice(at, 500)
                found = [main_text(x, weights) for x in texts(some.column(some.num_columns - 1))]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=names)

    kept = pages.select(*keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + ["text string", "n_chars long"])
    return pages.select(*keep, F.col(html_col).alias("html_to_read")).mapInArrow(scan, schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract_text(pages, ("page_id", "url"))
