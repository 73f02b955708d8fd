"""Main text of web pages: a bidirectional LSTM labels every block of a page, seeing the whole page.

A page is read into its leaf sequence: runs of text between block tags, with the path of open tags. Scripts,
styles, comments and other raw text never become blocks; svg, math, object and canvas are elements like any other.
Character references are decoded and white space inside a block becomes one space. Every block is turned into a vector:

- its tag path: every open tag, and every word of their class, id and role, hashed with a sign to ``PATH`` places;
- its words, lower-cased, hashed with a sign to ``WORDS`` places, scaled to length one;
- ``EXTRA`` plain figures: length, words, share of link text, end in punctuation, share of digits.

One LSTM reads the blocks from the front and one from the back; from both states a logistic unit tells main
text from the rest. It is written in numpy and runs over many pages at once, dealt by length.

Training. There are no labelled pages, so the teacher is the structure of the pages themselves: blocks inside
elements whose tag, class, id or role names them (``BOILERPLATE``) or in the title are not main text, others are. ``max_pages`` pages (parameter, default
``MAX_PAGES``), chosen by a hash of the id, are learnt by one task. Altered copies are learnt as well (one of each page, more of few pages), so that the
labeller does not depend on single hints: kinds of boilerplate the pages may lack (``GRAFTS``) are put in,
``article`` becomes a plain division, and tags of the path are left out. All pages are then labelled by the model.

A null or empty page, or one without blocks or main text, has the empty text. Repeated rows give repeated results. A
quote in a tag opens a value only behind an equals sign; a tag, comment or script without an end reaches to the
end of the page. Reading takes time and memory in proportion to the page, however deep its elements lie; the
inputs of the LSTM are taken ``STEPS`` blocks at a time. Ties do not arise; empty tables give empty results (a model
that has learnt nothing is not used); other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm.common import WordHashes, mix, prepare, remembers, serve

PATH, WORDS, EXTRA, HIDDEN = 48, 32, 6, 24
INPUT = PATH + WORDS + EXTRA
MAX_PAGES = 600
EPOCHS, LEAST_STEPS, BATCH, STEP = 6, 400, 16, 0.01
CELLS = 16_384
STEPS = 4096
COPIES = 300
SCHEMA = "page_id bigint, url string, text string, n_chars bigint, n_blocks bigint, n_main bigint"

# Tags that begin or end a block, tags whose text is not text, tags without an end, tags whose content
# follows rules of its own, and tags in them that hold ordinary content again.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW_TAGS = ("script", "style", "noscript", "template", "textarea", "iframe")
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FOREIGN_TAGS = frozenset(("svg", "math"))
FOREIGN_HOLDERS = frozenset("foreignobject desc title annotation-xml mi mn mo ms mtext".split())
BOILERPLATE = frozenset(
    "ad ads advert advertisement aside banner breadcrumb breadcrumbs button comment comments cookie cookies consent "
    "dialog footer form head header label legend login menu modal nav navigation newsletter notice option pagination "
    "popup promo related search select share sidebar social sponsor sponsored subscribe toc toolbar widget "
    "alert reply replies respond discussion disqus".split()
)
GRAFTS = (
    '<div class="cookie-notice"><p>{}</p></div>', '<aside class="sidebar"><h3>{}</h3><p>{}</p></aside>',
    '<div id="comments"><h2>{}</h2><div class="comment"><p>{}</p></div><div class="comment"><p>{}</p></div></div>',
    '<form action="/search"><label>{}</label><input name="q"><button>{}</button></form>',
    '<header><div class="logo">{}</div><p>{}</p></header>', '<div class="related"><ul><li><a href="/a">{}</a></li>'
    '<li><a href="/b">{}</a></li></ul></div>', '<div class="newsletter"><p>{}</p></div>',
    '<div class="banner notice"><p>{}</p></div>', '<section class="comments"><p>{}</p><p>{}</p></section>',
    '<div class="sidebar"><p>{}</p><p>{}</p></div>', '<div class="advert"><p>{}</p></div>',
)

_RAW = "|".join(RAW_TAGS)
# A quote opens a value only behind an equals sign; anywhere else it is a character like others.
_ATTRIBUTES = r"(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*"
TOKEN = re.compile(
    rf"<!--.*?(?P<over>-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>]){_ATTRIBUTES}>.*?(?P<close></(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>{_ATTRIBUTES})>|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME = re.compile(r"[a-z]+")
DIGIT = re.compile(r"\d")
_HASHES = WordHashes(200_000)
remembers("html_blocks", _HASHES.clear)


class Element:
    """An open element: its own words, and over its whole path the sum of the words' places and whether one is boilerplate."""

    __slots__ = ("name", "parent", "words", "sums", "main")

    def __init__(self, name: str, parent: Element | None, words: tuple[str, ...]):
        self.name, self.parent, self.words = name, parent, words
        self.sums = path_sums(words) + (parent.sums if parent else 0)
        own = "<title" not in words and not any(word.lstrip("<") in BOILERPLATE for word in words)
        self.main = own and (parent is None or parent.main)


class Block:
    """A leaf of a page: the element it is in, its text, how many of its characters are links."""

    __slots__ = ("element", "parts", "links", "text")

    def __init__(self, element: Element | None):
        self.element, self.parts, self.links, self.text = element, [], 0, ""

    @property
    def path(self) -> tuple[str, ...]:
        """The words of all elements around the block, outermost first."""
        found, at = [], self.element
        while at:
            found.append(at.words)
            at = at.parent
        return tuple(word for words in reversed(found) for word in words)


class Stack:
    """The open elements of a page. Every question takes the same time, however deep the page is."""

    def __init__(self):
        self.elements: list[Element] = []
        self.count: Counter[str] = Counter()
        self.places: dict[str, list[int]] = {"block": [], "foreign": [], "holder": []}

    def top(self) -> Element | None:
        return self.elements[-1] if self.elements else None

    def last(self, kind: str) -> int:
        """Where the innermost block, foreign element or holder of page content in one is; -1: nowhere."""
        return self.places[kind][-1] if self.places[kind] else -1

    def push(self, name: str, words: tuple[str, ...]) -> None:
        at = len(self.elements)
        self.elements.append(Element(name, self.top(), words))
        self.count[name] += 1
        for kind, names in (("block", BLOCK_TAGS), ("foreign", FOREIGN_TAGS), ("holder", FOREIGN_HOLDERS)):
            if name in names:
                self.places[kind].append(at)

    def cut(self, at: int) -> None:
        """Close the elements from a place on."""
        while len(self.elements) > at:
            self.count[self.elements.pop().name] -= 1
        for places in self.places.values():
            while places and places[-1] >= at:
                places.pop()

    def close(self, name: str) -> None:
        """An end tag: closes the innermost element of its name and those in it, if there is one."""
        if self.count[name]:
            at = len(self.elements) - 1
            while self.elements[at].name != name:
                at -= 1
            self.cut(at)

    def open(self, name: str, attrs: str) -> None:
        if name in FOREIGN_TAGS or self.places["foreign"]:
            within = self.last("foreign")
            if attrs.endswith("/"):
                return
            # A block tag of the page ends an svg or math element that was left open.
            if within >= 0 and name in BLOCK_TAGS - FOREIGN_HOLDERS and self.last("holder") < within:
                self.cut(within)
        if name in ("p", "li", "dt", "dd", "option", "tr", "td", "th"):
            # An open element of the same kind, with nothing but text tags in it, ends here.
            within = self.last("block")
            if within >= 0 and self.elements[within].name == name:
                self.cut(within)
        words = [f"<{name}"]
        for value in ATTRIBUTE.findall(attrs):
            words += NAME.findall("".join(value).lower())
        self.push(name, tuple(words))


def blocks(page: str | None) -> list[Block]:
    """The blocks with text of a page, in order. None for a null or empty page, or one without text."""
    found: list[Block] = []
    stack = Stack()
    now: Block | None = None

    def add(raw: str) -> None:
        nonlocal now
        if not raw:
            return
        if now is None:
            if not raw.strip():
                return
            now = Block(stack.top())
            found.append(now)
        text = html.unescape(raw) if "&" in raw else raw
        now.parts.append(text)
        if stack.count["a"]:
            now.links += len(text.strip())

    at = 0
    page = page or ""
    # Nothing behind the last > is a tag.
    for token in TOKEN.finditer(page, 0, page.rfind(">") + 1):
        add(page[at : token.start()])
        at = token.end()
        if token["over"] == "" or token["close"] == "":  # a comment or raw text without an end
            at = len(page)
        name = token["name"]
        if not name:
            continue
        name = name.lower()
        if name in BLOCK_TAGS:
            now = None
        elif name == "br" and now is not None:
            now.parts.append(" ")
        if token["end"]:
            stack.close(name)
        elif name not in VOID_TAGS:
            stack.open(name, token["attrs"])
    add(page[at:])
    kept = []
    for block in found:
        block.text = " ".join("".join(block.parts).split())
        if block.text:
            kept.append(block)
    return kept


def taught(block: Block) -> bool:
    """What the structure says of a block."""
    return block.element is None or block.element.main


def _placed(words: list[str], places: int) -> tuple[np.ndarray, np.ndarray]:
    codes = mix(_HASHES.of(words))
    return (codes % np.uint64(places)).astype(np.int64), np.where(codes >> np.uint64(63), 1.0, -1.0)


@lru_cache(4096)
def path_sums(words: tuple[str, ...]) -> np.ndarray:
    """The words of a path, summed over their hashed places."""
    places, signs = _placed(list(words), PATH)
    return np.bincount(places, signs, PATH) if words else np.zeros(PATH)


def vectors(page: list[Block], paths: list[tuple[str, ...]] | None = None) -> np.ndarray:
    """One row per block; ``paths`` stands for the words of the blocks' own paths."""
    out = np.zeros((len(page), INPUT), np.float32)
    if not page:
        return out
    for k, block in enumerate(page):
        if paths:
            out[k, :PATH] = path_sums.__wrapped__(paths[k])
        elif block.element:
            out[k, :PATH] = block.element.sums
    words = [block.text.lower().split(" ") for block in page]
    places, signs = _placed([w for own in words for w in own], WORDS)
    rows = np.repeat(np.arange(len(page)), [len(own) for own in words])
    sums = np.bincount(rows * WORDS + places, signs, len(page) * WORDS).reshape(len(page), WORDS)
    out[:, PATH : PATH + WORDS] = sums / np.maximum(np.sqrt((sums * sums).sum(1)), 1)[:, None]
    for k, block in enumerate(page):
        text = block.text
        out[k, PATH + WORDS :] = (
            np.log1p(len(text)) / 8, np.log1p(len(words[k])) / 6, block.links / len(text),
            text[-1] in ".!?…:;\"'", len(DIGIT.findall(text)) / len(text), 1.0,
        )
    return out


def _tanh_gate(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Labeller:
    """Weights of both directions and of the output unit, and what it takes to use and to learn them."""

    NAMES = ("wx0", "wh0", "b0", "wx1", "wh1", "b1", "w", "b")

    def __init__(self, seed: int = 5):
        made, h = np.random.default_rng(seed), HIDDEN
        self.p = {}
        for k in (0, 1):
            self.p[f"wx{k}"] = made.normal(0, INPUT**-0.5, (INPUT, 4 * h)).astype(np.float32)
            self.p[f"wh{k}"] = made.normal(0, h**-0.5, (h, 4 * h)).astype(np.float32)
            self.p[f"b{k}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32)
        self.p["w"] = made.normal(0, h**-0.5, 2 * h).astype(np.float32)
        self.p["b"] = np.zeros(1, np.float32)

    def _forward(self, k: int, x: np.ndarray, learn: bool) -> tuple[np.ndarray, list]:
        """States of one direction over time-major inputs, and what the way back needs."""
        steps, width, n = len(x), x.shape[1], HIDDEN
        h = c = np.zeros((width, n), np.float32)
        states, kept = np.empty((steps, width, n), np.float32), []
        for t in range(steps):
            if t % STEPS == 0:  # inputs of a very long page are taken in parts
                fed = x[t : t + STEPS] @ self.p[f"wx{k}"] + self.p[f"b{k}"]
            z = fed[t % STEPS] + h @ self.p[f"wh{k}"]
            gates, g = _tanh_gate(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[t] = h
            if learn:
                kept.append((i, f, o, g, tc, before_h, before_c))
        return states, kept

    def _backward(self, k: int, x: np.ndarray, kept: list, dstates: np.ndarray, grads: dict) -> None:
        n = HIDDEN
        dz = np.empty((len(x), x.shape[1], 4 * n), np.float32)
        dh_next = dc_next = 0.0
        for t in reversed(range(len(x))):
            i, f, o, g, tc, before_h, before_c = kept[t]
            dh = dstates[t] + dh_next
            dc = dh * o * (1 - tc * tc) + dc_next
            dz[t] = np.concatenate(
                [dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1
            )
            dh_next, dc_next = dz[t] @ self.p[f"wh{k}"].T, dc * f
            grads[f"wh{k}"] += before_h.T @ dz[t]
        grads[f"wx{k}"] += np.tensordot(x, dz, ((0, 1), (0, 1)))
        grads[f"b{k}"] += dz.sum((0, 1))

    @staticmethod
    def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs by time, how to turn each page round, and which places hold a block."""
        sizes = np.array([len(p) for p in pages])
        x = np.zeros((sizes.max(), len(pages), INPUT), np.float32)
        for k, page in enumerate(pages):
            x[: len(page), k] = page
        time = np.arange(sizes.max())[:, None]
        live = time < sizes[None, :]
        return x, np.where(live, sizes[None, :] - 1 - time, time), live

    def logits(self, pages: list[np.ndarray], learn: bool = False):
        x, turn, live = self._padded(pages)
        which = np.arange(len(pages))[None, :]
        there, kept0 = self._forward(0, x, learn)
        turned = x[turn, which]
        back, kept1 = self._forward(1, turned, learn)
        both = np.concatenate([there, back[turn, which]], axis=2)
        out = both @ self.p["w"] + self.p["b"]
        return (out, x, turned, turn, which, live, both, kept0, kept1) if learn else out

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of each page, the chance of every block to be main text. Pages are dealt out by length."""
        found: list[np.ndarray] = [np.empty(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            some = order[-max(1, CELLS // longest) :]
            del order[-len(some) :]
            out = _tanh_gate(self.logits([pages[k] for k in some]))
            for place, k in enumerate(some):
                found[k] = out[: len(pages[k]), place]
        return found

    def learn(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Labeller:
        """Adam over batches of (vectors, labels)."""
        order = np.random.default_rng(11)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, parts = 0, max(1, len(pages) // BATCH)
        for _ in range(max(epochs, -(-LEAST_STEPS // parts))):
            for some in np.array_split(order.permutation(len(pages)), parts):
                got = self.logits([pages[k][0] for k in some], learn=True)
                out, x, turned, turn, which, live, both, kept0, kept1 = got
                y = np.zeros(out.shape, np.float32)
                for place, k in enumerate(some):
                    y[: len(pages[k][1]), place] = pages[k][1]
                dout = ((_tanh_gate(out) - y) * live / live.sum()).astype(np.float32)
                grads = {k: np.zeros_like(v) for k, v in self.p.items()}
                grads["w"], grads["b"] = np.tensordot(both, dout, ((0, 1), (0, 1))), dout.sum(keepdims=True)[0]
                dboth = dout[:, :, None] * self.p["w"]
                self._backward(0, x, kept0, dboth[:, :, :HIDDEN], grads)
                self._backward(1, turned, kept1, dboth[:, :, HIDDEN:][turn, which], grads)
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    fixed = STEP * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.p[k] -= (fixed * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
        return self


def altered(page: str, texts: list[str], made: np.random.Generator) -> str:
    """The page with boilerplate it may lack, and without the names that give its article away."""
    for _ in range(made.integers(1, 4)):
        graft = GRAFTS[made.integers(len(GRAFTS))]
        words = [texts[made.integers(len(texts))] for _ in range(graft.count("{}"))]
        graft = graft.format(*(html.escape(w, quote=False) for w in words))
        # Elsewhere a graft would lie inside an element that is boilerplate itself, which teaches nothing new.
        places = [m.start() for m in re.finditer(r"<p>|<h1>|</article>|<footer|<article", page)]
        at = places[made.integers(len(places))] if places else len(page)
        page = page[:at] + graft + page[at:]
    if made.random() < 0.5:
        page = page.replace("<article", "<div").replace("</article", "</div")
    return page


def examples(pages: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of pages as they are and of altered copies with parts of the paths left out."""
    made = np.random.default_rng(3)
    read = [blocks(page) for page in pages]
    texts = [" ".join(b.text.split(" ")[: made.integers(2, 40)]) for own in read for b in own] or ["-"]
    out = []
    copies = max(1, COPIES // max(1, len(pages)))
    for page, own in zip(pages, read, strict=True):
        changed = [(blocks(altered(page, texts, made)), 0.1) for _ in range(copies)]
        for some, leave in ((own, 0.0), *changed):
            if not some:
                continue
            labels = np.array([taught(b) for b in some], np.float32)
            paths = [tuple(w for w in b.path if made.random() >= leave) for b in some] if leave else None
            out.append((vectors(some, paths), labels))
    return out


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    if rows and (made := examples([page for _, page in rows])):
        model = Labeller().learn(made)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.p[name].tobytes()], pa.binary()) for name in Labeller.NAMES], list(Labeller.NAMES)
        )


def fit(pages: DataFrame, max_pages: int = MAX_PAGES) -> Labeller:
    """Learn from a bounded choice of pages, by a hash of the id; of several pages of one id from the smallest."""
    ids = pages.where("html <> ''").select("page_id").where("page_id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)
    rows = pages.join(F.broadcast(chosen), "page_id").selectExpr("cast(page_id as bigint) AS page_id", "html")
    rows = rows.where("html <> ''").groupBy("page_id").agg(F.min("html").alias("html"))
    model = Labeller()
    schema = ", ".join(f"{name} binary" for name in Labeller.NAMES)
    for got in rows.repartition(1).mapInArrow(_train, schema).collect():
        for name in Labeller.NAMES:
            model.p[name] = np.frombuffer(got[name], np.float32).reshape(model.p[name].shape).copy()
    return model


def main_text(spark: SparkSession, pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """The main text of every page; one row out per row in."""
    prepare(spark)
    held = spark.sparkContext.broadcast(model or fit(pages))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serve("html_blocks")
        for batch in batches:
            read = [blocks(page) for page in batch.column("html").to_pylist()]
            chances = held.value.probabilities([vectors(own) for own in read])
            main = [[b.text for b, p in zip(own, ps, strict=True) if p >= 0.5] for own, ps in zip(read, chances, strict=True)]
            texts = ["\n".join(own) for own in main]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64()), pa.array(list(map(len, read)), pa.int64()),
                 pa.array(list(map(len, main)), pa.int64())],
                [part.split()[0] for part in SCHEMA.split(", ")],
            )

    return pages.selectExpr("cast(page_id as bigint) AS page_id", "cast(url as string) AS url", "html").mapInArrow(label, SCHEMA)
