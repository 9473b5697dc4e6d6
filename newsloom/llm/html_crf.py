"""Main-text extraction with a linear-chain conditional random field over DOM leaf blocks.

A page is parsed into leaf blocks: runs of text between block-level tags, in page order, each with
its ancestor tags, at any depth, and their class, id and role words. Scripts, styles and other unrendered content
are no blocks. Features are the ancestors, the block's own tag, and the text's length, link share,
punctuation and place; the field labels the chain of blocks as main text or not, and Viterbi
decoding takes the best chain.

Training pages are labelled: generated pages with known main text (many layouts: articles, plain
containers, menus, notices, adverts, forms, comments), and about ``sample_pages`` pages of the
input (those with the smallest hashed ids) that mark their article with ``article`` or ``main``.
The likelihood's gradient (forward-backward) is followed in numpy on the driver; only the features
of the sample's blocks reach it; pages of more than ``sample_blocks`` blocks are not learned from.

Defined results: a null or empty html, and a page without a main block, give an empty text;
character references are decoded, white space inside a block becomes one space, blocks are joined
by two newlines; unclosed and stray tags are repaired as browsers do for paragraphs and list
items, and marked sections (``<![...>``) are skipped up to the next ``>``; repeated rows get the same answer each; an empty table gives an empty result. Columns other
than id, url and html are not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import ROW, with_row_id

SAMPLE_PAGES, SAMPLE_BLOCKS = 150, 1000
GENERATED_PAGES, ROUNDS, RATE, DECAY, SEED = 400, 150, 0.15, 1e-3, 11

# Fixed values of HTML: tags that start a block, that are not rendered, and that have no end.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
search section summary table tbody td tfoot th thead tr ul""".split())
HIDDEN_TAGS = frozenset("script style noscript template title iframe object svg math audio video canvas".split())
FORM_TAGS = frozenset("button select option textarea label input".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Block tags that end an open element of the same group.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tbody", "thead"}, "tfoot": {"tbody", "thead"}}
SCOPES = frozenset("ul ol dl table body article section div main aside nav".split())
#: Words of classes, ids and roles that say what an element is for (own lists).
BOILERPLATE = frozenset("""nav navigation navbar menu menubar breadcrumb breadcrumbs sidebar aside footer foot
header masthead topbar banner ad ads advert adverts advertisement sponsor sponsored promo promotion cookie cookies
consent notice alert gdpr popup modal overlay share sharing social follow related recommended more comment comments
reply replies respond discussion disqus form login signup subscribe newsletter search widget pagination pager legal
copyright complementary contentinfo toolbar tags skip""".split())
MAIN = frozenset("content article post entry story main body text maincontent postcontent entrycontent".split())
SERVING_TAGS = frozenset("nav aside footer form button label select".split())
DEEPEST = 2  # nearest ancestors that a leaf names apart (own, parent); features come from all of them


@lru_cache(maxsize=20_000)
def element_features(tag: str, words: tuple[str, ...]) -> tuple[str, ...]:
    found = {f"in:{tag}"}
    for word in words:
        found.add(f"word:{word}")
        if word in BOILERPLATE:
            found.add("is:boilerplate")
        if word in MAIN:
            found.add("is:main")
    return tuple(sorted(found))


@dataclass(eq=False)
class Element:
    tag: str
    words: tuple[str, ...]
    label: str | None = None
    parent: Element | None = field(default=None, repr=False)
    new: tuple[str, ...] = ()  # features that no ancestor has
    markup: int | None = None  # main text by the markup of all ancestors: 1, 0 for a serving part inside it, else None
    weight: float | None = None  # of the features of this element and all its ancestors


@dataclass
class Leaf:
    text: str
    path: tuple[Element, ...]  # the nearest ancestors, innermost last; Element.parent leads to the others
    links: int  # characters inside links
    label: int | None = None


class BlockParser(HTMLParser):
    """Collects the leaf blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.leaves: list[Leaf] = []
        self.stack: list[Element] = []
        self.open: Counter[str] = Counter()  # tags on the stack: stray end tags cost no search
        self.inherited: set[str] = set()  # features of the elements on the stack
        self.hidden: list[str] = []
        self.parts: list[str] = []
        self.links = self.in_link = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            label = self.stack[-1].label if self.stack else None
            self.leaves.append(Leaf(text, tuple(self.stack[-DEEPEST:]), min(self.links, len(text)),
                                    None if label is None else int(label == "1")))
        self.parts, self.links = [], 0

    def close_open(self, tags: set[str] | frozenset[str], scope: frozenset[str]) -> None:
        """End the innermost open element among the tags, unless a scope element lies inside it."""
        if not any(self.open[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag in tags:
                return self.cut(at)
            if self.stack[at].tag in scope:
                return

    def cut(self, at: int) -> None:
        for element in self.stack[at:]:
            self.open[element.tag] -= 1
            self.inherited.difference_update(element.new)
        del self.stack[at:]

    def push(self, tag: str, words: tuple[str, ...], label: str | None) -> None:
        outer = self.stack[-1] if self.stack else None
        new = tuple(f for f in element_features(tag, words) if f not in self.inherited)
        self.inherited.update(new)
        self.stack.append(Element(tag, words, label or (outer.label if outer else None), outer, new,
                                  markup_label(tag, words, outer.markup if outer else None)))
        self.open[tag] += 1

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.hidden.clear()
        if tag in HIDDEN_TAGS:
            self.hidden.append(tag)
            return
        if tag == "a":
            self.in_link = 1
        if tag == "br":
            self.parts.append(" ")
        if tag not in BLOCK_TAGS and tag not in FORM_TAGS:
            return
        self.flush()
        if tag in BLOCK_TAGS:
            self.in_link = self.in_link if tag not in ("p", "li", "td", "div") else 0
            self.close_open({"p"}, SCOPES)
            if tag in CLOSES:
                self.close_open(CLOSES[tag], SCOPES)
        if tag not in VOID_TAGS:
            found = dict(attrs)
            words = re.findall("[a-z]+", " ".join(found.get(k) or "" for k in ("class", "id", "role")).lower())
            self.push(tag, tuple(words), found.get("data-label"))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in HIDDEN_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in HIDDEN_TAGS:
            if tag in self.hidden:
                del self.hidden[len(self.hidden) - 1 - self.hidden[::-1].index(tag):]
            return
        if tag == "a":
            self.in_link = 0
        if tag in ("head", "body", "html"):
            self.hidden.clear()
        if tag not in BLOCK_TAGS and tag not in FORM_TAGS:
            return
        self.flush()
        if self.open[tag]:
            self.cut(next(at for at in range(len(self.stack) - 1, -1, -1) if self.stack[at].tag == tag))

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.in_link:
                self.links += len(data)

    def parse_marked_section(self, i, report=1):
        """HTML has no marked sections: any ``<![`` starts a comment that ends at the next ``>``."""
        return self.parse_bogus_comment(i, report)


def leaf_blocks(html: str | None) -> list[Leaf]:
    parser = BlockParser()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.leaves


def place_features(path: tuple[Element, ...]) -> list[str]:
    """Of the two nearest ancestors, beside what is inherited."""
    return [f"{name}:{element.tag}" for name, element in zip(("own", "parent"), reversed(path))]


def path_features(path: tuple[Element, ...]) -> list[str]:
    """Of all ancestors, at any depth."""
    found = place_features(path)
    element = path[-1] if path else None
    while element:
        found.extend(element.new)
        element = element.parent
    return sorted(found)


def text_features(leaf: Leaf, place: int, count: int) -> list[str]:
    words = leaf.text.count(" ") + 1
    share = leaf.links / len(leaf.text)
    found = [f"words:{min(7, words.bit_length())}", f"links:{int(share * 4)}", f"end:{int(leaf.text[-1] in '.!?:')}",
             f"commas:{min(3, leaf.text.count(','))}", f"place:{min(4, 5 * place // count)}"]
    if "©" in leaf.text:
        found.append("has:copyright")
    if place == 0:
        found.append("place:first")
    if place == count - 1:
        found.append("place:last")
    return found


def markup_label(tag: str, words: tuple[str, ...], outer: int | None) -> int | None:
    """Main text: inside an article or main element, and in nothing inside it that serves the page."""
    serving = bool(BOILERPLATE & set(words))
    if outer == 0:
        return 0
    if tag in ("article", "main") and not serving:
        return 1
    if outer == 1 and (tag in SERVING_TAGS or serving):
        return 0
    return outer


def label_by_markup(leaf: Leaf) -> int:
    return (leaf.path[-1].markup or 0) if leaf.path else 0


class GeneratedPages:
    """Labelled pages: layouts of main text and everything around it, with invented words."""

    SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi wo zu ken lor min tas ver".split()

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.pick(self.SYLLABLES) for _ in range(int(self.rng.integers(1, 4))))
                        for _ in range(int(self.rng.integers(low, high + 1))))

    def sentence(self, low: int = 5, high: int = 18) -> str:
        text = self.words(low, high).split()
        if len(text) > 6 and self.chance(0.5):
            text[len(text) // 2] += ","
        return " ".join(text).capitalize() + "."

    def paragraph(self) -> str:
        return " ".join(self.sentence() for _ in range(int(self.rng.integers(1, 7))))

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/x">{self.words(1, 3)}</a></li>' for _ in range(int(self.rng.integers(low, high + 1))))

    def boilerplate(self, body: str) -> str:
        tag, words = self.pick([("div", "ad"), ("div", "ads banner"), ("div", "cookie-notice"), ("div", "sidebar"),
                                ("aside", ""), ("aside", "related"), ("nav", ""), ("nav", "menu"), ("div", "menu"),
                                ("footer", ""), ("div", "footer"), ("header", ""), ("div", "header"), ("form", ""),
                                ("form", "newsletter subscribe"), ("div", "share social"), ("div", "promo"),
                                ("section", "comments"), ("div", "comment-list"), ("div", "breadcrumb"),
                                ("div", "notice"), ("div", "alert"), ("ul", "nav"), ("div", "widget")])
        name = self.pick(["class", "id"])
        mark = f' {name}="{words}"' if words else ""
        return f'<{tag}{mark} data-label="0">{body}</{tag}>'

    def noise(self) -> str:
        kind = int(self.rng.integers(6))
        if kind == 0:
            return self.boilerplate(f"<ul>{self.links(2, 8)}</ul>")
        if kind == 1:
            return self.boilerplate(self.sentence())
        if kind == 2:
            return self.boilerplate(f"<p>{self.paragraph()}</p>")
        if kind == 3:
            return self.boilerplate(f"<h3>{self.words(1, 3)}</h3><p>{self.sentence()}</p><p>{self.paragraph()}</p>")
        if kind == 4:
            return self.boilerplate(f'<label>{self.words(1, 2)}</label><input><button>{self.words(1, 2)}</button>')
        return f'<footer data-label="0">&copy; {self.words(1, 3)} {self.sentence(2, 8)}</footer>'

    def page(self) -> str:
        parts = [f"<h1>{self.words(2, 9)}</h1>"] if self.chance(0.8) else []
        if self.chance(0.2):
            parts = [f"<header>{''.join(parts)}</header>"] if parts else []
        for _ in range(int(self.rng.integers(1, 10))):
            kind = int(self.rng.integers(12))
            if kind == 0:
                parts.append(f"<h2>{self.words(1, 6)}</h2>")
            elif kind == 1:
                parts.append("<ul>" + "".join(f"<li>{self.sentence(2, 9)}</li>" for _ in range(3)) + "</ul>")
            elif kind == 2:
                parts.append(f"<blockquote>{self.sentence()}</blockquote>")
            elif kind == 3 and self.chance(0.6):
                parts.append(self.noise())
            elif kind == 4:
                parts.append(f'<p>{self.sentence()} <a href="/y">{self.words(1, 3)}</a> {self.sentence()}')
            elif kind == 5:
                parts.append(f"<p>{self.words(1, 4)}</p>")
            elif kind == 6:
                parts.append(f"<p><b>{self.sentence()}<br>")
            else:
                parts.append(f"<p>{self.paragraph()}</p>")
        tag, words = self.pick([("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("div", "content"),
                                ("div", "post-content"), ("div", "entry"), ("section", "story"), ("div", "article-body"),
                                ("div", "main"), ("div", "text")])
        mark = f' {self.pick(["class", "id"])}="{words}"' if words else ""
        main = f'<{tag}{mark} data-label="1">{"".join(parts)}</{tag}>'
        if self.chance(0.3):
            main = f'<main data-label="0">{main}{self.noise() if self.chance(0.5) else ""}</main>'
        before = "".join(self.noise() for _ in range(int(self.rng.integers(0, 4))))
        after = "".join(self.noise() for _ in range(int(self.rng.integers(0, 4))))
        return f'<html><head><title>{self.words(2, 6)}</title></head><body data-label="0">{before}{main}{after}</body></html>'


def generated_sequences(pages: int, seed: int) -> list[tuple[list[list[str]], list[int]]]:
    made, out = GeneratedPages(seed), []
    for _ in range(pages):
        leaves = leaf_blocks(made.page())
        if leaves:
            out.append(([path_features(x.path) + text_features(x, i, len(leaves)) for i, x in enumerate(leaves)],
                        [x.label or 0 for x in leaves]))
    return out


@dataclass
class Field:
    """Weights of main text against the rest: emissions by feature, and transitions [from, to]."""

    weights: dict[str, float]
    start: np.ndarray
    moves: np.ndarray

    def inherited(self, element: Element | None) -> float:
        """Weight of the features of an element and all its ancestors, summed once an element."""
        todo = []
        while element and element.weight is None:
            todo.append(element)
            element = element.parent
        total = element.weight if element else 0.0
        for element in reversed(todo):
            total += sum(self.weights.get(f, 0.0) for f in element.new)
            element.weight = total
        return total

    def emission(self, leaf: Leaf, place: int, count: int) -> float:
        base = self.inherited(leaf.path[-1] if leaf.path else None)
        return base + sum(self.weights.get(f, 0.0) for f in place_features(leaf.path) + text_features(leaf, place, count))

    def viterbi(self, scores: list[float]) -> list[int]:
        """Best labels for emissions of label 1 (those of label 0 are zero)."""
        if not scores:
            return []
        (aa, ab), (ba, bb) = self.moves.tolist()
        zero, one = float(self.start[0]), float(self.start[1]) + scores[0]
        back = []
        for s in scores[1:]:
            from_zero, from_one = zero + ab, one + bb
            to_zero = (zero + aa, one + ba)
            back.append((int(to_zero[1] > to_zero[0]), int(from_one > from_zero)))
            zero, one = max(to_zero), max(from_zero, from_one) + s
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def main_blocks(self, html: str | None) -> list[str]:
        leaves = leaf_blocks(html)
        scores = [self.emission(x, i, len(leaves)) for i, x in enumerate(leaves)]
        return [x.text for x, label in zip(leaves, self.viterbi(scores)) if label]


class Chains:
    """Labelled sequences as flat arrays: blocks in the order of their step, longest sequence first, so
    step t is one stretch of the sequences that have a t-th block. Features are (block, feature) pairs;
    memory grows with what is there, not with the longest page or the number of features."""

    def __init__(self, sequences: list[tuple[list[list[str]], list[int]]]):
        ordered = sorted(sequences, key=lambda s: -len(s[1]))
        names = sorted({f for features, _ in ordered for block in features for f in block})
        self.number = {f: i for i, f in enumerate(names)}
        lengths = np.array([len(labels) for _, labels in ordered])
        self.active = [int((lengths > t).sum()) for t in range(int(lengths[0]))]
        self.begin = np.concatenate(([0], np.cumsum(self.active)))
        self.size = int(self.begin[-1])
        self.labels = np.zeros(self.size, dtype=np.int64)
        block, feature = [], []
        for s, (features, labels) in enumerate(ordered):
            for t, found in enumerate(features):
                at = int(self.begin[t]) + s
                self.labels[at] = labels[t]
                block.extend([at] * len(set(found)))
                feature.extend(self.number[f] for f in set(found))
        self.block, self.feature = np.array(block, dtype=np.int64), np.array(feature, dtype=np.int64)
        self.moves = np.zeros((2, 2))
        for t in range(1, len(self.active)):
            n = self.active[t]
            np.add.at(self.moves, (self.labels[self.begin[t - 1]:self.begin[t - 1] + n], self.labels[self.begin[t]:self.begin[t] + n]), 1)

    def likelihood(self, weights: np.ndarray, start: np.ndarray, moves: np.ndarray
                   ) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Negative log-likelihood of the labels and its gradients, by the forward-backward pass."""
        emission = np.zeros((self.size, 2))
        emission[:, 1] = np.bincount(self.block, weights[self.feature], minlength=self.size)
        ahead, back = emission.copy(), np.zeros((self.size, 2))
        first = slice(0, self.active[0])
        ahead[first] += start
        for t in range(1, len(self.active)):
            n, now, was = self.active[t], int(self.begin[t]), int(self.begin[t - 1])
            ahead[now:now + n] += np.logaddexp.reduce(ahead[was:was + n, :, None] + moves, axis=1)
        for t in range(len(self.active) - 2, -1, -1):
            n, now, after = self.active[t + 1], int(self.begin[t]), int(self.begin[t + 1])
            back[now:now + n] = np.logaddexp.reduce(moves + (emission[after:after + n] + back[after:after + n])[:, None, :], axis=2)
        norm = np.logaddexp.reduce(ahead[first] + back[first], axis=1)
        of_block = np.concatenate([norm[:n] for n in self.active])
        single = np.exp(ahead + back - of_block[:, None])
        pairs = np.zeros((2, 2))
        for t in range(1, len(self.active)):
            n, now, was = self.active[t], int(self.begin[t]), int(self.begin[t - 1])
            pairs += np.exp(ahead[was:was + n, :, None] + moves + (emission[now:now + n] + back[now:now + n])[:, None, :]
                            - norm[:n, None, None]).sum(axis=0)
        begun = np.bincount(self.labels[first], minlength=2)
        value = norm.sum() - (emission[np.arange(self.size), self.labels].sum() + (begun * start).sum() + (self.moves * moves).sum())
        gap = single[:, 1] - self.labels
        return (float(value), np.bincount(self.feature, gap[self.block], minlength=len(weights)),
                single[first].sum(axis=0) - begun, pairs - self.moves)


def train(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = ROUNDS, rate: float = RATE,
          decay: float = DECAY) -> Field:
    """Maximise the penalised likelihood of the labelled sequences, all chains side by side."""
    chains = Chains(sequences)
    theta = [np.zeros(len(chains.number)), np.zeros(2), np.zeros((2, 2))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in theta]
    for step in range(1, rounds + 1):
        _, *grads = chains.likelihood(*theta)
        for p, g, (m, v) in zip(theta, grads, moments):
            g = g / chains.size + decay * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    weights, start, moves = theta
    return Field({f: float(weights[i]) for f, i in chains.number.items()}, start, moves)


def sampled_sequences(pages: DataFrame, id_col: str, html_col: str, sample_pages: int, sample_blocks: int
                      ) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of the sample's pages that mark their article: whole pages, of at most
    ``sample_blocks`` blocks each."""
    order = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    last = pages.select(order.alias("order")).orderBy("order").limit(sample_pages).agg(F.max("order")).first()[0]
    if last is None:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for html in batch.column("html").to_pylist():
                leaves = leaf_blocks(html)
                labels = [label_by_markup(x) for x in leaves]
                if any(labels) and len(labels) <= sample_blocks:
                    features = [path_features(x.path) + text_features(x, i, len(leaves)) for i, x in enumerate(leaves)]
                    out.append(json.dumps([features, labels]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["page"])

    rows = pages.filter(order <= F.lit(last)).select(F.col(html_col).alias("html")).mapInArrow(run, "page string")
    return [tuple(json.loads(r["page"])) for r in rows.orderBy("page").limit(sample_pages).collect()]


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES,
        sample_blocks: int = SAMPLE_BLOCKS, generated_pages: int = GENERATED_PAGES, seed: int = SEED) -> Field:
    sampled = sampled_sequences(pages, id_col, html_col, sample_pages, sample_blocks)
    return train(sampled + generated_sequences(generated_pages, seed))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      model: Field | None = None, **options) -> DataFrame:
    """One row per input row: ``_row``, ``id``, ``url``, ``blocks`` (main blocks), ``text`` (joined)."""
    model = model or fit(pages, id_col, html_col, **options)
    source = with_row_id(pages, F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    types = {c: source.schema[c].dataType.simpleString() for c in ("id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                blocks = [model.main_blocks(html) for html in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in (ROW, "id", "url")] + [pa.array(blocks, pa.list_(pa.string()))],
                    names=[ROW, "id", "url", "blocks"])

    rows = source.mapInArrow(run, f"{ROW} long, id {types['id']}, url {types['url']}, blocks array<string>")
    return rows.withColumn("text", F.concat_ws("\n\n", "blocks"))
