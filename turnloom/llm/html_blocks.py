"""Main text of web pages by a bidirectional LSTM over their blocks.

A page is a sequence of leaf blocks, the text between two block-level tags. Each block is read
as hashed vectors of its tag path (element names, class and id words, parent and child) and of
its words, with its length, link share, punctuation and place. The network runs over the whole
page in both directions, so every block is judged in the context of all others; blocks with a
probability of a half or more are the main text, and headings right before such a block in the
same element.

It is trained on a bounded sample, TRAIN_PAGES different pages of PAGE_BYTES at most by hash order;
the hashes are ordered first, so that only the chosen pages leave their tasks. Weak labels come from
pages whose markup says what is what (article or main, against nav, aside, footer, ads, forms,
comments). A class or id says so as a whole: `share-buttons` is made of names of page parts only,
`share-prices` and `login-story` are not. An article's own header element is a header. Each such page is also shown in changed forms: boilerplate from
other pages added around and inside, and the telling elements replaced by divisions with the
usual class names, so that the network does not depend on one template.

Text that is never shown (scripts, styles, titles, comments of the markup) is no block.
Character references are decoded, white space inside a block becomes one space.

Cases: NULL or empty HTML gives empty text. Text outside any element is a block. Unclosed
elements end with the page, an unclosed script or comment hides the rest. Without pages to learn
from, the markup alone decides. Repeated pages are judged alike. Columns of the input with the
name of a result column are replaced.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import small_batches, text_chunks, text_or_empty
from turnloom.llm.words import split_words

TRAIN_PAGES, PAGE_BYTES = 240, 50_000
PATH_SIZE, WORD_SIZE, PLAIN_SIZE, HIDDEN = 256, 96, 6, 16
INPUT = PATH_SIZE + WORD_SIZE + PLAIN_SIZE
EPOCHS, RATE, BATCH = 10, 0.02, 40

INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_ELEMENTS = "script style noscript template title iframe svg textarea select".split()
CLOSES = {
    "p": {"p"},
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
    "option": {"option"},
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(HIDDEN_ELEMENTS)})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)>"
    r"|<[!?][^>]*>",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

MAIN = set("article main".split())
ASIDE = set("nav aside footer header form menu dialog".split())
MAIN_WORDS = set("articlebody main-content post-content entry-content story-body".split())
ASIDE_WORDS = set(
    "ad ads advert advertisement banner sponsored promo sidebar nav menu navigation footer header "
    "cookie cookies notice consent newsletter subscribe comment comments respond related share "
    "social breadcrumb pagination toc widget form login search".split()
)
# What such names are combined with: `site-header`, `nav-list`, `related-posts`.
PLACE_WORDS = set(
    "site page top bottom left right main inner outer list item items box bar block area slot unit section "
    "wrap wrapper container content body text title links link buttons button icons posts articles signup "
    "popup modal overlay results thread reply replies".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())


@lru_cache(maxsize=20_000)
def names_aside(word: str) -> bool:
    """Whether a class or id names a part of the page beside the article."""
    parts = [p for p in word.split("-") if p and not p.isdigit()]
    return bool(set(parts) & ASIDE_WORDS) and set(parts) <= ASIDE_WORDS | PLACE_WORDS


@dataclass
class BlockText:
    text: str
    path: tuple[str, ...]
    linked: int


def _marks(tag: str, attributes: str) -> str:
    """An element as `tag.word.word`, from its class, id and role."""
    words = [tag]
    if attributes and "=" in attributes:
        for _, a, b, c in ATTRIBUTE.findall(attributes):
            words += re.split(r"[^a-z0-9-]+", (a or b or c).lower())
    return ".".join(w for w in words if w)


def blocks_of(html: str) -> list[BlockText]:
    """The leaf blocks of a page in order."""
    found: list[BlockText] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = anchors = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                found.append(BlockText(text, tuple(m for _, m in stack), linked))
            parts, linked = [], 0

    at = 0
    for token in TOKEN.finditer(html):
        if token.start() > at:
            part = html[at : token.start()]
            parts.append(part)
            linked += len(part) if anchors else 0
        at = token.end()
        tag = (token[3] or token[6] or "").lower()
        if not tag:
            continue
        closing = bool(token[2] or token[5])
        if tag in INLINE:
            if tag == "a":
                anchors = 0 if closing else 1
            elif tag == "br":
                parts.append("\n")
            continue
        flush()
        anchors = 0
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
        elif tag not in VOID:
            ends = CLOSES.get(tag, {"p"})
            while stack and stack[-1][0] in ends:
                stack.pop()
            stack.append((tag, _marks(tag, token[4] or token[7] or "")))
    if at < len(html):
        parts.append(html[at:])
    flush()
    return found


# --- what the network reads ------------------------------------------------------------------


@lru_cache(maxsize=20_000)
def _path_slots(path: tuple[str, ...]) -> tuple[int, ...]:
    names = []
    for depth, mark in enumerate(path):
        words = mark.split(".")
        names += [f"{words[0]}."] if depth else []
        # Parts of a name count as such only in names of page parts.
        names += [f".{part}" for w in words[1:] for part in ({w, *w.split("-")} if names_aside(w) else {w})]
        names += ["aside name" for w in words[1:] if names_aside(w)]
        names += [f".{w}" for w in words[:1] if w in MAIN | ASIDE]
    if path:
        names.append("leaf " + path[-1].split(".")[0])
        names.append("in " + ">".join(m.split(".")[0] for m in path[-2:]))
    return tuple(sorted({zlib.crc32(n.encode()) % PATH_SIZE for n in names}))


def inputs(blocks: list[BlockText]) -> np.ndarray:
    """One row of numbers per block of a page."""
    x = np.zeros((len(blocks), INPUT), np.float32)
    total = sum(len(b.text) for b in blocks) or 1
    before = 0
    for i, block in enumerate(blocks):
        x[i, list(_path_slots(block.path))] = 1
        n = len(block.text)
        marks = sum(map(block.text.count, ".,;:!?"))
        x[i, PATH_SIZE + WORD_SIZE :] = (
            np.log1p(n) / 6,
            min(1.0, block.linked / n),
            min(1.0, 10 * marks / n),
            i / len(blocks),
            before / total,
            n / total,
        )
        before += n
    words = split_words([b.text.encode() for b in blocks])
    slots = (words.hashes() % np.uint64(WORD_SIZE)).astype(np.int64)
    counts = np.bincount(words.text * WORD_SIZE + slots, minlength=len(blocks) * WORD_SIZE)
    counts = counts.reshape(len(blocks), WORD_SIZE)
    x[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True)))
    return x


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """time x page x input, and which of these are there."""
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), INPUT), np.float32)
    there = np.zeros((longest, len(pages)), np.float32)
    for i, page in enumerate(pages):
        x[: len(page), i], there[: len(page), i] = page, 1
    return x, there


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """The network: per direction input, recurrent and bias weights, and one output row."""

    def __init__(self, seed: int = 3) -> None:
        draw = np.random.default_rng(seed).normal
        self.weights = {}
        for side in "fb":
            self.weights["x" + side] = draw(0, 0.15, (INPUT, 4 * HIDDEN)).astype(np.float32)
            self.weights["h" + side] = draw(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.weights["b" + side] = bias
        self.weights["o"] = draw(0, 0.15, (2 * HIDDEN + 1,)).astype(np.float32)

    def _run(self, x: np.ndarray, there: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """Hidden states of one direction; a page's state stays as it is where it has ended."""
        w = self.weights
        drive = x @ w["x" + side] + w["b" + side]
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        c = np.zeros_like(h)
        states, kept = np.zeros((*x.shape[:2], HIDDEN), np.float32), []
        order = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
        for t in order:
            gates = drive[t] + h @ w["h" + side]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            on = there[t][:, None]
            new = on * (f * c + i * g) + (1 - on) * c
            tanh = np.tanh(new)
            kept.append((t, h, c, i, f, o, g, tanh, on))
            h = on * (o * tanh) + (1 - on) * h
            c = new
            states[t] = h
        return states, kept

    def probabilities(self, x: np.ndarray, there: np.ndarray) -> np.ndarray:
        both = [self._run(x, there, side)[0] for side in "fb"]
        return _sigmoid(np.concatenate(both, axis=2) @ self.weights["o"][:-1] + self.weights["o"][-1])

    def gradients(self, x: np.ndarray, there: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, runs = self.weights, {side: self._run(x, there, side) for side in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        error = (_sigmoid(states @ w["o"][:-1] + w["o"][-1]) - y) * there / there.sum()
        grad = {"o": np.append(np.einsum("tp,tph->h", error, states), error.sum())}
        for at, side in enumerate("fb"):
            out = w["o"][at * HIDDEN : (at + 1) * HIDDEN]
            dh, dc = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
            grad["h" + side] = np.zeros_like(w["h" + side])
            drive = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tanh, on in reversed(runs[side][1]):
                dh = dh + error[t][:, None] * out
                into = on * dh
                dnew = dc + into * o * (1 - tanh * tanh)
                dgates = np.concatenate(
                    [
                        on * dnew * g * i * (1 - i),
                        on * dnew * c * f * (1 - f),
                        into * tanh * o * (1 - o),
                        on * dnew * i * (1 - g * g),
                    ],
                    axis=1,
                )
                drive[t] = dgates
                grad["h" + side] += h.T @ dgates
                dh = (1 - on) * dh + dgates @ w["h" + side].T
                dc = dnew * (on * f + (1 - on))
            grad["x" + side] = np.tensordot(x, drive, ((0, 1), (0, 1)))
            grad["b" + side] = drive.sum((0, 1))
        return grad

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], seed: int = 5) -> None:
        draw = np.random.default_rng(seed)
        moment = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order, step = sorted(range(len(pages)), key=lambda i: len(pages[i])), 0
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for epoch in range(EPOCHS):
            for b in draw.permutation(len(batches)):
                x, there = padded([pages[i] for i in batches[b]])
                y = np.zeros_like(there)
                for k, i in enumerate(batches[b]):
                    y[: len(labels[i]), k] = labels[i]
                step += 1
                rate = RATE * (1 - epoch / EPOCHS) + 0.001
                for k, grad in self.gradients(x, there, y).items():
                    grad = np.clip(grad, -1, 1).astype(np.float32)
                    moment[k] = 0.9 * moment[k] + 0.1 * grad
                    square[k] = 0.99 * square[k] + 0.01 * grad * grad
                    fixed = moment[k] / (1 - 0.9**step)
                    self.weights[k] -= rate * fixed / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)

    def label(self, pages: list[list[BlockText]]) -> list[np.ndarray]:
        """Which blocks of each page are main text; pages of like length run together."""
        result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        first = 0
        while first < len(order):
            # a bounded number of cells: many short pages or a few long ones
            end = first + 1
            while end < len(order) and (end + 1 - first) * len(pages[order[end]]) <= 8_000:
                end += 1
            some = order[first:end]
            x, there = padded([inputs(pages[i]) for i in some])
            p = self.probabilities(x, there)
            for k, i in enumerate(some):
                result[i] = p[: len(pages[i]), k] >= 0.5
            first = end
        return result


# --- learning from markup --------------------------------------------------------------------


def marked_main(path: tuple[str, ...]) -> bool:
    """What the markup says of a block: the innermost telling element decides."""
    for mark in reversed(path):
        tag, *words = mark.split(".")
        if tag in ASIDE or any(map(names_aside, words)):
            return False
        if tag in MAIN or set(words) & MAIN_WORDS:
            return True
    return False


# Usual names of page parts.
CONTENT_NAMES = "content main-content post-content entry-content story-body article-body post entry text".split()
OUTER_NAMES = "page wrapper container layout site column row".split()
ADDED = [
    ("header", "header.site-header"), ("header", "div.header"), ("nav", "nav"), ("nav", "div.menu"),
    ("aside", "aside"), ("aside", "div.sidebar"), ("aside", "div.related"), ("aside", "div.widget"),
    ("notice", "div.cookie-notice"), ("notice", "div.notice"), ("notice", "div.consent-banner"),
    ("ad", "div.ad"), ("ad", "div.advertisement"), ("ad", "div.sponsored"), ("ad", "div.promo-banner"),
    ("form", "form"), ("form", "div.newsletter"), ("form", "div.search"),
    ("comments", "section.comments"), ("comments", "div.comment"), ("comments", "ol.comment-list"),
    ("footer", "footer"), ("footer", "div.footer"), ("share", "div.share"), ("toc", "div.breadcrumb"),
]
BEFORE = {"header", "nav", "notice", "ad", "form", "toc"}


def changed_page(
    blocks: list[BlockText], main: np.ndarray, texts: list[str], draw: np.random.Generator
) -> tuple[list[BlockText], np.ndarray]:
    """The page with other containers and added boilerplate; texts are lent by other pages."""
    outer = ("html", "body") + tuple(
        f"div.{OUTER_NAMES[draw.integers(len(OUTER_NAMES))]}" for _ in range(draw.integers(0, 3))
    )
    content = [
        ("article",), ("main",), ("main", "article"),
        (f"div.{CONTENT_NAMES[draw.integers(len(CONTENT_NAMES))]}",),
        (f"section.{CONTENT_NAMES[draw.integers(len(CONTENT_NAMES))]}",),
    ][draw.integers(5)]

    def extra(mark: str, around: tuple[str, ...]) -> list[BlockText]:
        leaf = "li" if mark.split(".")[0] in ("nav", "ol", "footer") or draw.random() < 0.3 else "p"
        if draw.random() < 0.25:
            leaf = ""
        some = []
        for _ in range(draw.integers(1, 5)):
            text = texts[draw.integers(len(texts))]
            linked = 0
            if leaf == "li" or draw.random() < 0.2:
                text = " ".join(text.split()[: draw.integers(1, 6)])
                linked = len(text)
            if text:
                some.append(BlockText(text, (*around, mark, *([leaf] if leaf else [])), linked))
        return some

    # A name that says nothing, made of words of a page.
    plain = "-".join(re.findall("[a-z]+", texts[draw.integers(len(texts))].lower())[:2])
    inner = (f"div.{plain}",) if plain and draw.random() < 0.3 and not names_aside(plain) else ()
    own = [BlockText(b.text, (*outer, *content, *inner, b.path[-1].split(".")[0]), b.linked)
           for b, m in zip(blocks, main) if m]
    rows, flags = [], []

    def add(some: list[BlockText], flag: bool) -> None:
        rows.extend(some)
        flags.extend([flag] * len(some))

    picks = [ADDED[i] for i in draw.permutation(len(ADDED))[: draw.integers(2, 8)]]
    for kind, mark in picks:
        if kind in BEFORE:
            add(extra(mark, outer), False)
    inside = [mark for kind, mark in picks if kind in ("ad", "share", "aside") and draw.random() < 0.4]
    cut = int(draw.integers(0, len(own) + 1))
    add(own[:cut], True)
    for mark in inside:
        add(extra(mark, (*outer, *content)), False)
    add(own[cut:], True)
    for kind, mark in picks:
        if kind not in BEFORE:
            add(extra(mark, (*outer, *content) if kind == "comments" and draw.random() < 0.5 else outer), False)
    return rows, np.array(flags, bool)


def with_headings(blocks: list[BlockText], main: np.ndarray) -> np.ndarray:
    """The main blocks and the headings that stand before one of them in the same element."""
    main = main.copy()
    for i in range(len(blocks) - 2, -1, -1):
        path, following = blocks[i].path, blocks[i + 1].path
        if main[i + 1] and not main[i] and path and path[-1].split(".")[0] in HEADINGS:
            main[i] = path[:-1] == following[:-1] and not any(map(names_aside, path[-1].split(".")[1:]))
    return main


def train(pages: list[str]) -> Labeller | None:
    known = [blocks_of(p) for p in pages]
    known = [(b, np.array([marked_main(x.path) for x in b])) for b in known if b]
    known = [(b, m) for b, m in known if m.any()]
    if not known:
        return None
    texts = [x.text for b, _ in known for x in b]
    draw = np.random.default_rng(11)
    shown = known + [changed_page(b, m, texts, draw) for b, m in known for _ in range(2)]
    labeller = Labeller()
    labeller.fit([inputs(b) for b, _ in shown], [m for _, m in shown])
    return labeller


def training_pages(pages: DataFrame, html: str) -> list[str]:
    """TRAIN_PAGES different pages by hash; tasks send hashes first, then only what is chosen."""
    sized = pages.filter(F.octet_length(text_or_empty(html)).between(1, PAGE_BYTES))
    hashed = sized.select(F.xxhash64(html).alias("h"), F.col(html).alias("page"))
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(TRAIN_PAGES).collect()]
    chosen = hashed.filter(F.col("h").isin(least)).groupBy("h").agg(F.min("page").alias("page"))
    return [r["page"] for r in chosen.orderBy("h").collect()]


def extract_main_text(
    pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """The key columns, text (main blocks joined by an empty line) and n_chars (code points)."""
    small_batches(pages.sparkSession)
    labeller = train(training_pages(pages, html))
    kept = [k for k in keys if k not in ("text", "n_chars")]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_chunks(batches, "_html"):
            known = [blocks_of(r.decode("utf-8", "replace")) for r in raw]
            if labeller is None:
                main = [np.array([marked_main(b.path) for b in page], bool) for page in known]
            else:
                main = labeller.label(known)
            main = [with_headings(page, flags) for page, flags in zip(known, main)]
            texts = [
                "\n\n".join(b.text for b, m in zip(page, flags) if m)
                for page, flags in zip(known, main)
            ]
            rest = batch.drop_columns(["_html"])
            yield rest.append_column("text", pa.array(texts, pa.string())).append_column(
                "n_chars", pa.array([len(t) for t in texts], pa.int64())
            )

    narrow = pages.select(*kept, text_or_empty(html).alias("_html"))
    schema = pages.select(
        *kept, F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n_chars")
    ).schema
    return narrow.mapInArrow(extract, schema)
