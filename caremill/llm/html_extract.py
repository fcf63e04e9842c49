"""HTML extraction by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by what they stand in: the element that holds them, the names,
classes and ids of the elements around it, and whether they are a link. Tags score negative. A linear scan finds the
contiguous region with the largest sum, and its blocks are the text. The weights are learned on labelled pages, those
whose authors marked the main text with an ``article`` element: a logistic regression of words on what they stand in,
and log odds of tags. Names that are known for menus, adverts, comments and the like start below zero; labelled pages
move them, and any other class or id that marks what isn't main text is learned from them. The mark only labels words:
it has no weight, and words outside of it score and are given out like any others.

Inside the region, what its author set apart is left out: elements for menus, asides and forms, and elements whose
own class or id has so low a weight that words in it count against the main text. A header or footer is left to the scan.
Such an element can also hold the whole page (a form or dialog around it, a class like ``widget``). Where the text found is under
a tenth of the page's words, elements that hold more than half of them say nothing, unless they are reader comments, and the page is
scanned again.

Scale: one pass over the pages, no shuffle. What at most LABELLED pages of at most LABELLED_BYTES each say is counted in
the tasks; the driver gets counts of distinct surroundings.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremill.llm.common import map_arrow, table

#: Bound of the labelled sample.
LABELLED, LABELLED_BYTES = 1000, 65536
#: Least cost of a tag, largest one of a tag that may hold anything and of others; words on a page for which the regression counts it; steps of the regression.
LEAST, LARGEST_GENERAL, LARGEST_TAG, PAGE_WORDS, STEPS = 0.1, 0.5, 2.0, 50.0, 400
#: How far weights are held to where they start: those of elements in general, and those of names, classes, ids and links.
HOLD_GENERAL, HOLD_NAMED = 2.0, 0.05
#: Where weights of known names start, and the sum of weights from which on an element in the region is left out.
KNOWN_WEIGHT, LEFT_OUT = -4.0, 0.0
#: Share of a page's words under which a text is doubted, and share of words from which on an element holds the page.
DOUBTED, HOLDS_PAGE = 0.1, 0.5

# Elements of HTML and what they are here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea select svg canvas object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover semantics annotation".split())
LOOSE = frozenset("p li dt dd tr td th option thead tbody tfoot html body head".split())
MAIN = frozenset(["article", "main"])
#: Elements that may hold anything: what they are says little.
GENERAL = (INLINE | LOOSE | frozenset("div section ul ol dl table figure figcaption blockquote pre center h1 h2 h3 h4 h5 h6".split())) - {"a"}
#: Elements that set something apart from running text, and whole classes or ids that are known for it.
APART = frozenset("nav aside form menu dialog button".split())
KNOWN = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments comment-list comments-area cookie-banner cookie-notice cookies footer menu navbar navigation newsletter pagination popup promo related-posts replies share sharing sidebar site-footer site-header social sponsored subscribe widget".split())
#: Whole classes or ids of reader comments, among the known ones.
COMMENTS = frozenset("comment comments comment-list comments-area replies".split())
#: A tag from its name to its end: a value may stand in quotes after "=", any other quote is a letter.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


class Piece:
    """A stretch of text: its block, its words, what it stands in, and whether it is in the marked article."""

    __slots__ = ("block", "text", "words", "around", "inside", "apart")

    def __init__(self, block: int, text: str, words: int, around: tuple[str, ...], inside: bool, apart: tuple):
        self.block, self.text, self.words, self.around, self.inside, self.apart = block, text, words, around, inside, apart


def tags_of(page: str) -> list[tuple]:
    """(start, end, name, closing, attributes) of the tags, in order; comments and declarations have no name. A tag that the
    end of the page cuts off reaches to the end. Reads each character a bounded number of times."""
    out, at = [], page.find("<")
    while at >= 0:
        then = page[at + 1 : at + 2]
        if then in ("!", "?"):
            end = page.find("-->", at + 4) + 3 if page.startswith("<!--", at) else page.find(">", at) + 1
            end = end if end > 2 or end > 0 and then == "?" else len(page)
            out.append((at, end, "", False, ""))
        elif then.isascii() and then.isalpha() or then == "/" and page[at + 2 : at + 3].isascii() and page[at + 2 : at + 3].isalpha():
            m = TAG.match(page, at)
            if not m:
                out.append((at, len(page), "", False, ""))
                break
            name, end = m[2].lower(), m.end()
            out.append((at, end, name, bool(m[1]), m[3]))
            if name in RAW and not m[1] and not m[3].endswith("/"):
                close = _raw_end(name).search(page, end)
                out.append((end, close.start() if close else len(page), "", False, ""))
                end = out[-1][1]
        else:
            end = at + 1
        at = page.find("<", end)
    return out


_RAW_ENDS: dict[str, re.Pattern] = {}


def _raw_end(name: str) -> re.Pattern:
    if name not in _RAW_ENDS:
        _RAW_ENDS[name] = re.compile(f"</{name}", re.I)
    return _RAW_ENDS[name]


def _pairs(tags: list[tuple]) -> dict[int, int]:
    """Places of the tags that open and close one element, each with the other. An opening tag that is still open where the element around it ends
    holds nothing, and a closing tag without an open element closes nothing."""
    open_at: dict[str, list[int]] = {}
    stack: list[int] = []
    found = {}
    for i, (_, _, name, closing, _) in enumerate(tags):
        if not name or name in VOID or name in LOOSE or name in RAW:
            continue
        if not closing:
            stack.append(i)
            open_at.setdefault(name, []).append(i)
        elif own := open_at.get(name):
            start = own.pop()
            while (last := stack.pop()) != start:
                open_at[tags[last][2]].pop()
            found[start], found[i] = i, start
    return found


def _own(name: str, attributes: str, weights: dict[str, float] | None) -> tuple[list[str], list[str]]:
    """What an element says of itself: its name, and its classes and ids; with weights only those that weigh something."""
    said = []
    for key, value in NAMED.findall(attributes) if "=" in attributes else ():
        said += [f"{key.lower()}:{x.lower()}" for x in html.unescape(value.strip("\"'")).split()]
    if weights is not None:
        said = [x for x in said if x in weights or start_of(x)]
    return ([] if name in MAIN else [f"under:{name}"]), said


def _holders(page: str, tags: list[tuple], paired: dict[int, int]) -> set[int]:
    """Opening tags of elements that hold more than half of the page's words, but for those of reader comments."""
    before, at, n = [], 0, 0
    for start, end, *_ in tags:
        n += len(page[at:start].split())
        before.append(n)
        at = end
    n += len(page[at:].split())
    wide = {i for i, j in paired.items() if i < j and before[j] - before[i] > HOLDS_PAGE * n}
    return {i for i in wide if not any(x.partition(":")[2] in COMMENTS for x in _own(tags[i][2], tags[i][4], None)[1])}


def pieces_of(page: str, weights: dict[str, float] | None = None, doubted: bool = False) -> list[Piece | tuple[str, bool]]:
    """Pieces of text and (tag, in the article), in page order. ``weights``: classes and ids that weigh nothing are left out.
    ``doubted``: elements that hold most of the page say nothing."""
    out: list = []
    tags = tags_of(page)
    paired = _pairs(tags)
    holders = _holders(page, tags, paired) if doubted else ()
    stack: list[tuple[str, list[str], bool]] = []  # name, what it says, whether it may be set apart
    counts: Counter = Counter()
    block, holder, inside, main, at = 0, "", 0, 0, 0
    apart: list[tuple] = []
    around: tuple[str, ...] | None = None

    def text(a: int, b: int) -> None:
        nonlocal around
        if a >= b:
            return
        raw = html.unescape(page[a:b]) if "&" in page[a:b] else page[a:b]
        if around is None:
            around = tuple(sorted({f"in:{holder}", *(k for k, n in counts.items() if n)}))
        out.append(Piece(block, raw, len(raw.split()), around, inside > 0, tuple(apart)))

    for i, (start, end, name, closing, attributes) in enumerate(tags):
        text(at, start)
        at = end
        if not name:
            continue
        if name not in INLINE:
            block += 1
            holder = "" if closing or name in VOID or name in MAIN or i in holders else name
            around = None
        elif name == "br":
            out.append(Piece(block, " ", 0, (), inside > 0, tuple(apart)))
        if closing and i in paired:
            _, said, maybe = stack.pop()
            counts.subtract(said)
            inside -= name == "article"
            main -= name in MAIN
            if maybe:
                apart.pop()
            around = None
        elif i in paired:
            own, said = ([], []) if i in holders else _own(name, attributes, weights)
            if name == "header" and main:
                own = []  # of the main text, not of the page
            maybe = i not in holders and name not in MAIN and (name in APART or bool(said))
            stack.append((name, own + said, maybe))
            counts.update(own + said)
            inside += name == "article"
            main += name in MAIN
            if maybe:
                apart.append((name, f"in:{name}", *own, *said))
            around = None
        if name not in MAIN:
            out.append((name, inside > 0))
    text(at, len(page))
    return out


def counts_of(page: str) -> tuple[Counter, Counter]:
    """Words by (surroundings, in the article), scaled so that a page counts for PAGE_WORDS, and tags by (name, in the article)."""
    words, tags = Counter(), Counter()
    for x in pieces_of(page):
        if isinstance(x, Piece):
            if x.words:
                words[x.around, x.inside] += x.words
        else:
            tags[x] += 1
    total = sum(words.values())
    return Counter({k: n * PAGE_WORDS / total for k, n in words.items()}), tags


def start_of(feature: str) -> float:
    kind, _, name = feature.partition(":")
    return KNOWN_WEIGHT if (kind in ("class", "id", "role") and name in KNOWN) or kind == "under" and name in APART | {"footer", "header"} else 0.0


def fitted(words: Counter) -> dict[str, float]:
    """Weights of what words stand in, and of a ``word plain``, without surroundings: a logistic regression by gradient steps, each weight held to where it starts."""
    features = sorted({f for around, _ in words for f in around})
    number = {f: i for i, f in enumerate(features)}
    keys = sorted(words)
    rows = np.repeat(np.arange(len(keys)), [len(k[0]) for k in keys])
    columns = np.array([number[f] for k in keys for f in k[0]], np.int64)
    inside, n = np.array([k[1] for k in keys], float), np.array([words[k] for k in keys], float)
    start = np.array([start_of(f) for f in features])
    hold = np.array([HOLD_GENERAL if f.partition(":")[0] in ("in", "under") and f.partition(":")[2] in GENERAL else HOLD_NAMED for f in features])
    w, bias, total = start.copy(), 1.0, max(n.sum(), 1.0)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, STEPS + 1):
        logits = bias + np.bincount(rows, w[columns], len(keys)) if len(keys) else np.zeros(0)
        wrong = n * (1 / (1 + np.exp(-logits)) - inside) * PAGE_WORDS / total
        grad = np.append(np.bincount(columns, wrong[rows], len(w)) + hold * (w - start), wrong.sum() + HOLD_NAMED * (bias - 1))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = 0.1 * (1 - (step - 1) / STEPS) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - float(move[-1])
    return dict(zip(features, w.tolist(), strict=True)) | {"word plain": bias}


def weights_of(words: Counter, tags: Counter) -> dict[str, float]:
    """Weights of surroundings, and of tags: log odds to stand outside the article, as a cost within bounds."""
    within, without = (Counter({t: n for (t, inside), n in tags.items() if inside is side}) for side in (True, False))
    a, b = within.total() + 1, without.total() + 1
    cost = lambda t: math.log((without[t] + 0.5) / b) - math.log((within[t] + 0.5) / a)
    return fitted(words) | {f"tag {t}": -max(LEAST, min(LARGEST_GENERAL if t in GENERAL else LARGEST_TAG, cost(t))) for t in {*within, *without}} | {"tag": -LEAST}


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous region with the largest sum, the first of several; (0, 0) if none is positive."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best:
            best, found = total, (start, i + 1)
    return found


class Extractor:
    """The weights, and the scores of the surroundings met."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.seen: dict[tuple, float] = {}

    def logit(self, features: tuple[str, ...]) -> float:
        """Score of a word in these surroundings. A known name that no labelled page has scores as it starts."""
        if features not in self.seen:
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[features] = self.weights["word plain"] + sum(self.weights[f] if f in self.weights else start_of(f) for f in features)
        return self.seen[features]

    def set_apart(self, piece: Piece) -> bool:
        """Whether it stands in an element that its author set apart: see the module's docstring."""
        return any(x[0] in APART or self.logit(x[1:]) < LEFT_OUT for x in piece.apart)

    def scores(self, pieces: list) -> list[float]:
        weights, other = self.weights, self.weights["tag"]
        return [x.words and x.words * self.logit(x.around) if isinstance(x, Piece) else weights.get(f"tag {x[0]}", other) for x in pieces]

    def kept(self, pieces: list) -> list[Piece]:
        """The pieces of the best region without what was set apart in it."""
        a, b = best_region(self.scores(pieces))
        return [x for x in pieces[a:b] if isinstance(x, Piece) and not (x.apart and self.set_apart(x))]

    def text(self, page: str) -> str:
        """The text of the best region: blocks joined by line feeds, white space in a block turned into one space."""
        pieces = pieces_of(page, self.weights)
        kept = self.kept(pieces)
        words = sum(x.words for x in pieces if isinstance(x, Piece))
        if sum(x.words for x in kept) < DOUBTED * words:
            kept = self.kept(pieces_of(page, self.weights, doubted=True)) or kept
        blocks: dict[int, list[str]] = {}
        for x in kept:
            blocks.setdefault(x.block, []).append(x.text)
        lines = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def main_text(page: str, weights: dict[str, float]) -> str:
    return Extractor(weights).text(page)


def learned_weights(pages: DataFrame, most: int = LABELLED, most_bytes: int = LABELLED_BYTES) -> dict[str, float]:
    """Weights from at most ``most`` labelled pages, chosen by a hash of their ids; without any, known names alone say something.

    Ids are chosen first; their pages are looked at in the tasks, and the driver gets distinct surroundings with their counts.
    """
    marked = pages.filter(F.col("html").rlike("(?i)<article[\\s>]") & (F.octet_length("html") <= most_bytes)).select(F.xxhash64("page_id", "url").alias("h"), "html")
    there = marked.count()
    if there > most:
        share = min(1.0, 1.5 * most / there)
        marked = marked.filter(F.pmod("h", F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
        last = marked.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]
        marked = marked.filter(F.col("h") <= F.lit(last))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tags = Counter(), Counter()
        for batch in parts:
            for page in batch.column("html").to_pylist():
                one, two = counts_of(page)
                words.update(one)
                tags.update(two)
        rows = [("word", list(k[0]), k[1], float(n)) for k, n in words.items()] + [("tag", [k[0]], k[1], float(n)) for k, n in tags.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True) if rows else [[]] * 4, (pa.string(), pa.list_(pa.string()), pa.bool_(), pa.float64()), strict=True)], ["kind", "names", "inside", "n"])

    found = map_arrow(marked.select("html"), run, "kind string, names array<string>, inside boolean, n double").groupBy("kind", "names", "inside").agg(F.sum("n").alias("n")).collect()
    words = Counter({(tuple(r.names), r.inside): round(r.n, 6) for r in found if r.kind == "word"})
    return weights_of(words, Counter({(r.names[0], r.inside): r.n for r in found if r.kind == "tag"}))


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. Null and empty pages have an empty text, and so have pages without a
    region of positive score; what a tag cut off by the end of a page holds is no text; repeated rows are extracted one by
    one; extra columns are ignored."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = Extractor(weights)
        for batch in parts:
            texts = [extractor.text(x or "") for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(pages.select("page_id", "url", "html"), run, f"page_id {id_type}, url string, text string, n_chars long")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learned_weights(pages))
