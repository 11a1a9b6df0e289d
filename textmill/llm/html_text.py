"""Main text of web pages: a recurrent labeller reads a page's blocks in order and decides each with the whole page as context.

A page is cut into blocks (the stretches of text between block-level tags, references decoded, white space made one space). A block is a vector: its
tag path (tags, class, id and role words of all open elements, hashed, outer ones weighing less), its words (hashed) and a few figures of its
length, links and marks. A bidirectional LSTM in numpy reads the vectors of a page forwards and backwards, and each block is article or not by
what both have seen. The texts of the article's blocks are joined by line feeds.

The model is trained here, on PAGES pages of random layouts whose blocks are known (html_layouts), once for each process of the driver, and sent to
the tasks: its size is fixed. Pages are labelled in groups of like length whose padded blocks are bounded; a page alone may have any number.

Defined cases: a null or empty page, and one without an article, gives an empty text; markup that doesn't end goes on to the end of the page, text of
scripts, styles, templates, head and comments is none; a text of any length is taken whole; pages without an id and repeated pages each give a row, an
empty table none; columns other than page_id, url and html, whatever their names, are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import BoundedCache, held, no_null_text, prepared
from textmill.llm.html_layouts import Layout

PAGES, EPOCHS = 2000, 12
PATH, WORD, FIGURES, HIDDEN = 128, 64, 8, 32
#: What an element's words weigh beside those of the element in it.
FADE = 0.85
#: Cells (pages times blocks, with padding) of a group.
CELLS = 1 << 15

# Fixed values of HTML: elements that begin and end blocks, that have no end, whose text is no markup, and whose text is never shown.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe input label legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead tr ul video audio object noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
HIDDEN_TAGS = frozenset("script style title template head noembed noframes iframe".split())
#: An element that begins ends an open one of these, up to those.
ENDS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
CLOSES_P = BLOCKS - frozenset("button input label option optgroup select body html head iframe object video audio textarea noscript".split())

_markup = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_attribute = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_part = re.compile(r"[a-z]+|\d+")
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")
_word = re.compile(r"[^\W\d_]+|\n")
_ENDS = frozenset(".!?:…\"»”")


def _place(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return h % size, 1.0 if h >> 31 else -1.0


class Reader:
    """Cuts pages into blocks, with what is known of elements and words kept in bounded caches."""

    def __init__(self):
        self.elements = BoundedCache(lambda keys: [self._element(k) for k in keys], 20_000)
        self.words = BoundedCache(lambda keys: [-1 if k == "\n" else zlib.crc32(k.encode("utf-8", "surrogatepass")) % (2 * WORD) for k in keys], 200_000, 64)

    @staticmethod
    def _element(key: tuple[str, str]) -> np.ndarray:
        """The vector of an element by its tag and attributes."""
        tag, attributes = key
        v = np.zeros(PATH, np.float32)
        i, sign = _place("<" + tag, PATH)
        v[i] += sign
        for m in _attribute.finditer(attributes):
            for w in set(_part.findall(_camel.sub(" ", m[2] or m[3] or m[4] or "").lower())):
                i, sign = _place(w, PATH)
                v[i] += sign
        return v

    def blocks(self, page: str) -> tuple[list[str], np.ndarray]:
        """The texts of a page's blocks, and a vector (path, words, figures) of each."""
        stack: list[tuple[str, np.ndarray]] = []
        open_: dict[str, int] = {}
        hidden = links = 0
        texts: list[str] = []
        paths: list[np.ndarray] = []
        shares: list[float] = []
        parts: list[str] = []
        linked = whole = 0
        path = zero = np.zeros(PATH, np.float32)
        first = path

        def pop() -> None:
            nonlocal hidden, links, path
            tag, _ = stack.pop()
            open_[tag] -= 1
            hidden -= tag in HIDDEN_TAGS
            links -= tag == "a"
            path = stack[-1][1] if stack else zero

        def flush() -> None:
            nonlocal linked, whole
            if parts:
                t = " ".join("".join(parts).split())
                if t:
                    texts.append(t)
                    paths.append(first)
                    shares.append(linked / max(1, whole))
                parts.clear()
            linked = whole = 0

        def say(text: str) -> None:
            nonlocal first, linked, whole
            if hidden or not text:
                return
            if not parts or not whole:
                first = path
            text = html.unescape(text) if "&" in text else text
            n = len(text.strip())
            whole += n
            linked += n if links else 0
            parts.append(text)

        at, end = 0, len(page)
        while at < end:
            m = _markup.search(page, at)
            if not m:
                say(page[at:])
                break
            say(page[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag == "br":
                    say(" ")
                if tag in BLOCKS and not hidden:
                    flush()
                if open_.get(tag):
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                continue
            if tag in BLOCKS and not hidden:
                flush()
            elif tag == "br":
                say(" ")
            if tag in CLOSES_P and open_.get("p"):
                while stack[-1][0] != "p":
                    pop()
                pop()
            if tag in ENDS:
                own, until = ENDS[tag]
                if any(open_.get(x) for x in own):
                    k = len(stack) - 1
                    while k >= 0 and stack[k][0] not in own and stack[k][0] not in until:
                        k -= 1
                    while k >= 0 and len(stack) > k and stack[k][0] in own:
                        pop()
                        while len(stack) > k:
                            pop()
            if tag == "body" and open_.get("head"):
                while open_["head"]:
                    pop()
            if tag in VOID or m[3].endswith("/") and tag not in BLOCKS and tag not in RAW:
                continue
            mine = self.elements.ensure([(tag, m[3])])[tag, m[3]] if len(m[3]) < 300 else self._element((tag, m[3]))
            path = path * FADE + mine
            stack.append((tag, path))
            open_[tag] = open_.get(tag, 0) + 1
            hidden += tag in HIDDEN_TAGS
            links += tag == "a"
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                raw_end = close.start() if close else end
                if tag == "textarea":
                    say(page[at:raw_end])
                at = raw_end
        flush()
        return texts, self.vectors(texts, paths, shares)

    def vectors(self, texts: list[str], paths: list[np.ndarray], shares: list[float]) -> np.ndarray:
        n = len(texts)
        out = np.zeros((n, PATH + WORD + FIGURES), np.float32)
        if not n:
            return out
        out[:, :PATH] = paths
        tokens = _word.findall("\n".join(texts).lower())
        known = self.words.ensure(tokens)
        ids = np.array([known[w] for w in tokens], np.int64)  # a line feed ends a block
        block = np.cumsum(ids < 0)
        c = np.bincount((block * 2 * WORD + ids)[ids >= 0], minlength=n * 2 * WORD).reshape(n, 2 * WORD)
        words = c.sum(axis=1)
        signed = c[:, :WORD] - c[:, WORD:]
        out[:, PATH : PATH + WORD] = 2 * signed / np.sqrt(np.maximum(1, (signed * signed).sum(axis=1)))[:, None]
        size = np.array([len(t) for t in texts])
        marks = np.array([t.count(".") + t.count(",") + t.count("!") + t.count("?") for t in texts])
        ends = [t[-1] in _ENDS for t in texts]
        out[:, PATH + WORD :] = np.stack([np.log1p(size) / 4, np.log1p(words) / 3, shares, ends, marks / (1 + words), np.arange(n) == 0, (np.arange(n) + 1) / n, np.full(n, np.log1p(n) / 4)], axis=1)
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM over the vectors of a page's blocks."""

    def __init__(self, seed: int = 7, hidden: int = HIDDEN):
        g = np.random.default_rng(seed)
        d, h = PATH + WORD + FIGURES, hidden
        some = lambda n, m: (g.standard_normal((n, m)) / n**0.5).astype(np.float32)
        self.p: dict[str, np.ndarray] = {}
        for way in "fb":
            bias = np.zeros(4 * h, np.float32)
            bias[h : 2 * h] = 1  # gates to forget are open at first
            self.p |= {f"x{way}": some(d, 4 * h), f"h{way}": some(h, 4 * h), f"c{way}": bias}
        self.p |= {"o": some(2 * h, 1)[:, 0], "v": np.zeros(d, np.float32), "z": np.zeros(1, np.float32)}
        self.h = h

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """States (pages, blocks, hidden) in one direction, and what is needed to go back."""
        b, n, _ = x.shape
        h = self.h
        gates_in = x @ self.p[f"x{way}"] + self.p[f"c{way}"]
        state, cell = np.zeros((b, h), np.float32), np.zeros((b, h), np.float32)
        out, kept = np.zeros((b, n, h), np.float32), []
        for t in range(n) if way == "f" else range(n - 1, -1, -1):
            g = gates_in[:, t] + state @ self.p[f"h{way}"]
            s = sigmoid(g[:, : 3 * h])
            i, f, o, u = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], np.tanh(g[:, 3 * h :])
            m = mask[:, t, None]
            new = f * cell + i * u
            tanh = np.tanh(new)
            if keep:
                kept.append((t, i, f, o, u, cell, tanh, state, m))
            cell = np.where(m, new, cell)
            state = np.where(m, o * tanh, state)
            out[:, t] = state
        return out, kept

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        f, b = self._run(x, mask, "f", False)[0], self._run(x, mask, "b", False)[0]
        return np.concatenate([f, b], axis=2) @ self.p["o"] + x @ self.p["v"] + self.p["z"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean loss of the blocks and its gradients, by going back through time."""
        runs = {w: self._run(x, mask, w, True) for w in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        z = both @ self.p["o"] + x @ self.p["v"] + self.p["z"]
        n, h = mask.sum(), self.h
        prob = sigmoid(z)
        loss = float((np.logaddexp(0, z) - y * z)[mask].sum() / n)
        dz = np.where(mask, prob - y, 0).astype(np.float32) / n
        grads = {"o": np.einsum("bt,bth->h", dz, both), "v": np.einsum("bt,btd->d", dz, x), "z": dz.sum(keepdims=True)[0]}
        for k, w in enumerate("fb"):
            d_out = dz[:, :, None] * self.p["o"][k * h : (k + 1) * h]
            dx = np.zeros((*x.shape[:2], 4 * h), np.float32)
            dh, dc = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
            dw = np.zeros_like(self.p[f"h{w}"])
            for t, i, f, o, u, cell, tanh, state, m in reversed(runs[w][1]):
                dh = dh + d_out[:, t]
                live_h, live_c = np.where(m, dh, 0), np.where(m, dc, 0)
                dcell = live_c + live_h * o * (1 - tanh * tanh)
                g = np.concatenate([dcell * u * i * (1 - i), dcell * cell * f * (1 - f), live_h * tanh * o * (1 - o), dcell * i * (1 - u * u)], axis=1)
                dx[:, t] = g
                dw += state.T @ g
                dh = np.where(m, 0, dh) + g @ self.p[f"h{w}"].T
                dc = np.where(m, dcell * f, dc)
            flat = dx.reshape(-1, 4 * h)
            grads |= {f"h{w}": dw, f"c{w}": flat.sum(axis=0), f"x{w}": x.reshape(len(flat), -1).T @ flat}
        return loss, grads


def groups(lengths: list[int], cells: int = CELLS) -> Iterator[list[int]]:
    """Places of pages, those of like length together, so that no group has more than `cells` padded blocks (but for a single page)."""
    order = [k for k in sorted(range(len(lengths)), key=lambda k: lengths[k]) if lengths[k]]
    at = 0
    while at < len(order):
        z = at + 1
        while z < len(order) and (z + 1 - at) * lengths[order[z]] <= cells:
            z += 1
        yield order[at:z]
        at = z


def padded(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = max(map(len, vectors))
    x, mask = np.zeros((len(vectors), n, vectors[0].shape[1]), np.float32), np.zeros((len(vectors), n), bool)
    for k, v in enumerate(vectors):
        x[k, : len(v)], mask[k, : len(v)] = v, True
    return x, mask


def labelled(seed: int, reader: Reader) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, vectors and labels of the blocks of one random page."""
    page = Layout(seed)
    texts, x = reader.blocks(page.html)
    said: dict[str, bool] = {}
    for text, article in page.out:
        t = " ".join(text.split())
        said[t] = said.get(t, True) and article
    return texts, x, np.array([said.get(t, False) for t in texts], np.float32)


def train(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 7, batch: int = 32) -> Labeller:
    """A labeller trained by Adam on so many random pages."""
    reader, model, g = Reader(), Labeller(seed), np.random.default_rng(seed)
    data = [(x, y) for _, x, y in (labelled(seed * 1_000_003 + k, reader) for k in range(pages)) if len(x)]
    order = sorted(range(len(data)), key=lambda k: len(data[k][0]))
    batches = [[data[k] for k in order[a : a + batch]] for a in range(0, len(order), batch)]
    m, v, step = {k: np.zeros_like(p) for k, p in model.p.items()}, {k: np.zeros_like(p) for k, p in model.p.items()}, 0
    for epoch in range(epochs):
        for k in g.permutation(len(batches)):
            x, mask = padded([a for a, _ in batches[k]])
            y = np.zeros(mask.shape, np.float32)
            y[mask] = np.concatenate([b for _, b in batches[k]])
            _, grads = model.gradients(x * (g.random(x.shape[2]) > 0.05), mask, y)  # now and then a feature is missing
            size = max(1.0, float(np.sqrt(sum((d * d).sum() for d in grads.values()))))
            step += 1
            rate = 0.006 * (1 - epoch / epochs) + 0.0005
            for n, d in grads.items():
                d = d / size
                m[n] += 0.1 * (d - m[n])
                v[n] += 0.001 * (d * d - v[n])
                model.p[n] = (model.p[n] - rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


@lru_cache(maxsize=2)
def trained(pages: int = PAGES, epochs: int = EPOCHS) -> Labeller:
    return train(pages, epochs)


def main_texts(pages: list[str], model: Labeller, reader: Reader) -> list[str]:
    read = [reader.blocks(p) for p in pages]
    out = [""] * len(pages)
    for group in groups([len(t) for t, _ in read]):
        x, mask = padded([read[k][1] for k in group])
        keep = model.logits(x, mask) > 0
        for row, k in enumerate(group):
            out[k] = "\n".join(t for t, good in zip(read[k][0], keep[row], strict=False) if good)
    return out


def extracted(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text (the article's), n_chars (its code points) for each row of pages (page_id, url, html)."""
    prepared(pages.sparkSession)
    model = model or trained()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = held(Reader)
        for b in batches:
            texts = main_texts(b.column(2).to_pylist(), model, reader)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", no_null_text("html").alias("html")).mapInArrow(rows, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
