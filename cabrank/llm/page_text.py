"""Main text of web pages by a recurrent labeller of blocks.

A page is cut into its leaf sequence: the pieces of text between tags of block elements, in page order, each with the
path of open elements (names, classes, ids and roles) that leads to it. Scripts, styles, other raw elements, comments
and the head hold no text. Every block becomes a vector: its path hashed, its words hashed, and its shape (length,
links, marks). A bidirectional LSTM in numpy reads the whole sequence of a page and gives each block the probability
of being main text, so a block is judged by the page around it. Blocks above one half are joined in page order.

The labeller is trained in one task on up to ``TRAIN_PAGES`` pages, which are those with the smallest hashes of their
ids and up to ``TRAIN_CHARS`` characters; every page is labelled by it, whole. There are no labels, so markup
that says what it is teaches: what stands in an article is main text, what stands in a menu, footer,
sidebar, form, advert, notice or comment section is not. To know other designs than those of the table, the blocks of
the sample are also dealt into invented layouts (``layouts``) with the usual names of such parts. Training has fixed seeds, so
reruns agree.

White space inside a block (space, tab, line feed, vertical tab, form feed, carriage return) becomes one space; ``br``
is white space. Null or empty html, and pages without main text, have an empty text. Pages of any length are read whole;
unclosed elements end with their parent. Repeated rows stay. An empty table gives an empty result. Further columns are
left alone, whatever their names.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TRAIN_PAGES = 256
TRAIN_CHARS = 60_000
#: Invented layouts for every page of the sample.
LAYOUTS = 8
EPOCHS = 6
HIDDEN = 16
PATH_SIZE = 512
WORD_SIZE = 64
SEED = 11
#: Characters of html whose blocks are labelled together; a longer page is a group of its own.
GROUP_CHARS = 8_000_000

# Element names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements a start tag ends, where they are the innermost open one.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|head|title|noscript|template|textarea|iframe|svg|object|video|audio|canvas)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
BLANKS = re.compile(r"[\x20\x09-\x0D]+")
NAME_PARTS = re.compile(r"[a-z]+")

#: A block: its path, its text and how many of its characters are in links.
Block = tuple[tuple[str, ...], str, int]


def blocks_of(page: str | None) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    page = page or ""
    found: list[Block] = []
    path: list[tuple[str, str]] = []  # element, its name with classes
    pieces: list[str] = []
    state = {"links": 0, "linked": 0}

    def close() -> None:
        text = BLANKS.sub(" ", html.unescape("".join(pieces))).strip(" ")
        if text:
            found.append((tuple(name for _, name in path), text, min(state["linked"], len(text))))
        pieces.clear()
        state["linked"] = 0

    at = 0
    for mark in MARKUP.finditer(page):
        if mark.start() > at:
            piece = page[at : mark.start()]
            pieces.append(piece)
            state["linked"] += len(piece) if state["links"] else 0
        at = mark.end()
        tag = (mark[3] or "").lower()
        if tag == "br":
            pieces.append(" ")
        elif tag == "a":
            state["links"] = 0 if mark[2] else 1
        if tag not in BLOCK_TAGS:
            continue
        close()
        if mark[2]:
            if any(tag == open_tag for open_tag, _ in path):
                while path.pop()[0] != tag:
                    pass
                state["links"] = 0
        else:
            ends = ENDED_BY.get(tag, ())
            while path and (path[-1][0] == "p" or path[-1][0] in ends):
                path.pop()
            if tag not in VOID_TAGS:
                names = " ".join(next(filter(None, m.groups()[1:]), "") for m in NAMED.finditer(mark[4])).lower()
                path.append((tag, tag if not names else f"{tag} {names}"))
    pieces.append(page[at:])
    close()
    return found


def path_words(path: tuple[str, ...]) -> list[str]:
    """The names in a path: elements as they are, words of classes, ids and roles apart, and the last element once more."""
    words = []
    for name in path:
        tag, _, rest = name.partition(" ")
        words.append(tag)
        words += [f".{w}" for w in NAME_PARTS.findall(rest)]
    return [*words, f"/{path[-1].partition(' ')[0]}"] if path else []


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    vector = np.zeros(PATH_SIZE, np.float32)
    for word in path_words(path):
        vector[zlib.crc32(word.encode()) % PATH_SIZE] = 1
    return vector


def word_matrix(texts: list[str]) -> np.ndarray:
    """The words of every text, hashed; rows of length one."""
    lists = [t.lower().encode("utf-8", "surrogatepass").split() for t in texts]
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    cells = np.fromiter((zlib.crc32(w) % WORD_SIZE for x in lists for w in x), np.int64, len(rows))
    counts = np.bincount(rows * WORD_SIZE + cells, minlength=len(lists) * WORD_SIZE).reshape(-1, WORD_SIZE).astype(np.float32)
    return counts / np.maximum(np.sqrt((counts**2).sum(axis=1, keepdims=True)), 1)


def shapes(blocks: list[Block]) -> np.ndarray:
    rows = []
    for path, text, linked in blocks:
        n = len(text)
        words = text.count(" ") + 1
        marks = sum(map(text.count, ".,;:!?"))
        rows.append((np.log1p(n) / 8, np.log1p(words) / 6, linked / n, 10 * marks / n, n / words / 10, text[-1] in ".!?", len(path) / 8, 1))
    return np.array(rows, np.float32).reshape(-1, 8)


#: Where the sequences of a batch start, their lengths, the vectors of their blocks as from ``vectors``, and the labels.
Batch = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def by_length(pages: list[list[Block]]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The places of the pages by falling length, and where the blocks of each begin in that order, and how many they are."""
    order = sorted(range(len(pages)), key=lambda k: -len(pages[k]))
    lengths = np.array([len(pages[k]) for k in order], np.int64)
    return order, np.cumsum(lengths) - lengths, lengths


def prepared(pages: list[list[Block]], labels: list[np.ndarray]) -> Batch:
    order, starts, lengths = by_length(pages)
    return starts, lengths, *vectors([b for k in order for b in pages[k]]), np.concatenate([labels[k] for k in order]).astype(np.float32)


class Labeller:
    """A bidirectional LSTM over sequences of block vectors with one logistic output a block."""

    def __init__(self, seed: int = SEED):
        rnd = np.random.default_rng(seed)
        self.inputs = PATH_SIZE + WORD_SIZE + 8
        draw = lambda *shape: (rnd.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.weights = {}
        for side in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1  # forget little at first
            self.weights |= {f"w{side}": draw(self.inputs, 4 * HIDDEN), f"u{side}": draw(HIDDEN, 4 * HIDDEN), f"c{side}": bias}
        self.weights |= {"v": draw(2 * HIDDEN), "d": np.zeros(1, np.float32)}

    def projected(self, side: str, paths: np.ndarray, of: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """What each block adds to the gates; every distinct path is multiplied once."""
        w = self.weights[f"w{side}"]
        return (paths @ w[:PATH_SIZE])[of] + rest @ w[PATH_SIZE:] + self.weights[f"c{side}"]

    def run(self, side: str, inputs: np.ndarray, starts: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """States of every block; sequences are sorted by falling length. ``keep`` also returns what the gradient needs."""
        u = self.weights[f"u{side}"]
        states = np.zeros((len(inputs), HIDDEN), np.float32)
        h = np.zeros((len(starts), HIDDEN), np.float32)
        c = np.zeros_like(h)
        steps = []
        for t in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -t, "left"))  # sequences longer than t
            at = starts[:n] + (t if side == "f" else lengths[:n] - 1 - t)
            gates = inputs[at] + h[:n] @ u
            i, f, o = (1 / (1 + np.exp(-gates[:, k * HIDDEN : (k + 1) * HIDDEN])) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            before, h_before = c[:n], h[:n]
            c = f * before + i * g
            tanh = np.tanh(c)
            h = o * tanh
            states[at] = h
            if keep:
                steps.append((at, i, f, o, g, before, tanh, h_before))
        return (states, steps) if keep else states

    def probabilities(self, pages: list[list[Block]]) -> list[np.ndarray]:
        order, starts, lengths = by_length(pages)
        paths, of, rest = vectors([b for k in order for b in pages[k]])
        states = [self.run(side, self.projected(side, paths, of, rest), starts, lengths) for side in "fb"]
        main = 1 / (1 + np.exp(-(np.concatenate(states, axis=1) @ self.weights["v"] + self.weights["d"])))
        result: list = [None] * len(pages)
        for k, start, n in zip(order, starts, lengths):
            result[k] = main[start : start + n]
        return result

    def gradient(self, prepared: Batch) -> tuple[float, dict[str, np.ndarray]]:
        """The mean loss over the blocks and its derivatives by all weights (backpropagation through time)."""
        starts, lengths, paths, of, rest, target = prepared
        whole = np.concatenate([paths[of], rest], axis=1)
        sides = {s: self.run(s, self.projected(s, paths, of, rest), starts, lengths, keep=True) for s in "fb"}
        states = np.concatenate([sides["f"][0], sides["b"][0]], axis=1)
        main = 1 / (1 + np.exp(-(states @ self.weights["v"] + self.weights["d"])))
        loss = -float(np.mean(np.where(target > 0, np.log(main + 1e-9), np.log(1 - main + 1e-9))))
        error = (main - target) / len(target)
        slopes = {"v": states.T @ error, "d": error.sum(keepdims=True)}
        outer = error[:, None] * self.weights["v"]
        for place, side in enumerate("fb"):
            u = self.weights[f"u{side}"]
            from_output = outer[:, place * HIDDEN : (place + 1) * HIDDEN]
            gate_slopes, u_slope = np.zeros((len(target), 4 * HIDDEN), np.float32), np.zeros_like(u)
            dh = np.zeros((0, HIDDEN), np.float32)
            dc = np.zeros((0, HIDDEN), np.float32)
            for at, i, f, o, g, before, tanh, h_before in reversed(sides[side][1]):
                n = len(at)
                dh = np.concatenate([dh, np.zeros((n - len(dh), HIDDEN), np.float32)]) + from_output[at]
                dc = np.concatenate([dc, np.zeros((n - len(dc), HIDDEN), np.float32)]) + dh * o * (1 - tanh**2)
                gates = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tanh * o * (1 - o), dc * i * (1 - g**2)], axis=1)
                gate_slopes[at] = gates
                u_slope += h_before.T @ gates
                dh, dc = gates @ u.T, dc * f
            slopes |= {f"w{side}": whole.T @ gate_slopes, f"u{side}": u_slope, f"c{side}": gate_slopes.sum(axis=0)}
        return loss, slopes

    def train(self, pages: list[list[Block]], labels: list[np.ndarray], epochs: int = EPOCHS, batch: int = 32, rate: float = 0.01) -> None:
        """Adam over batches of pages of similar length."""
        rnd = np.random.default_rng(SEED)
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        batches = [prepared([pages[i] for i in order[k : k + batch]], [labels[i] for i in order[k : k + batch]]) for k in range(0, len(order), batch)]
        first = {k: np.zeros_like(w) for k, w in self.weights.items()}
        second = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step = 0
        for _ in range(epochs):
            for place in rnd.permutation(len(batches)):
                _, slopes = self.gradient(batches[place])
                step += 1
                for k, slope in slopes.items():
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope**2
                    change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = (self.weights[k] - rate * change).astype(np.float32)


def vectors(blocks: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of the distinct paths, which of them each block has, and its words and shape."""
    places: dict[tuple[str, ...], int] = {}
    of = np.array([places.setdefault(path, len(places)) for path, _, _ in blocks], np.int64)
    paths = np.array([path_vector(p) for p in places], np.float32).reshape(-1, PATH_SIZE)
    return paths, of, np.concatenate([word_matrix([t for _, t, _ in blocks]), shapes(blocks)], axis=1)


# Names that pages give to their parts, as elements or as classes and ids of a div, section or aside.
MAIN_NAMES = "article content post entry story body text main prose blog news page".split()
SIDE_NAMES = (
    "ad ads advert advertisement sponsor sponsored promo banner sidebar side aside widget related recommended more nav navigation menu "
    "navbar topbar breadcrumb breadcrumbs header masthead footer foot bottom copyright notice notices cookie cookies consent gdpr alert "
    "warning message popup modal overlay newsletter subscribe signup login search form share social tags meta byline pagination pager "
    "comment comments commentlist reply replies discussion respond disqus feedback toolbar skip legal disclaimer announcement "
    "complementary contentinfo"
).split()
#: Those that stand inside a main part most often.
INNER_NAMES = "ad ads advert promo sponsored aside sidebar related share newsletter comment comments".split()
#: Words that go with a name, in main and other parts alike.
NAME_ENDS = "box body list item text area wrapper inner content section block title links buttons posts".split()
TITLE_NAMES = "title headline heading entry-title post-title article-title page-title".split()
SIDE_TAGS = "nav header footer aside form menu button label select option legend".split()


def taught(path: tuple[str, ...]) -> int | None:
    """1 for what stands in a main part, 0 for what stands in another, None where the path does not say."""
    words = path_words(path)
    names = {w.lstrip(".") for w in words if w.startswith(".")}
    if set(words) & set(SIDE_TAGS) or names & set(SIDE_NAMES):
        return 0
    return 1 if {"article", "main"} & set(words) or names & {"article", "main", "content", "post", "entry", "story"} else None


def layouts(rnd: np.random.Generator, prose: list[str], side: list[str], n: int) -> Iterator[tuple[list[Block], np.ndarray]]:
    """Invented pages: paragraphs of the sample in a main part, other parts before, in and after it, with their labels."""
    pick = lambda values: values[int(rnd.integers(len(values)))]

    def bare(above: tuple[str, ...]) -> list[Block]:
        """A part without a name: only its links tell that it is not main text."""
        inner = pick([("div", "ul", "li"), ("ul", "li"), ("div",), ("div", "p"), ("p",), ("div", "div"), ("table", "tr", "td")])
        one = inner[-1] != "li" and rnd.random() < 0.7
        sign = pick([" | ", " - ", " / ", " "])
        blocks = []
        for _ in range(1 if one else int(rnd.integers(2, 8))):
            links = [" ".join(pick(side).split()[: int(rnd.integers(1, 4))]) or "more" for _ in range(int(rnd.integers(1, 6)) if one else 1)]
            blocks.append(((*above, *inner), sign.join(links), sum(map(len, links))))
        return blocks

    def part(above: tuple[str, ...], within: bool = False) -> list[Block]:
        """A part that is not main text: short links, or prose of its own, as in comments and notices."""
        if not within and rnd.random() < 0.2:
            return bare(above)
        name = pick(INNER_NAMES if within and rnd.random() < 0.6 else SIDE_NAMES)
        kind = int(rnd.integers(4))
        top = pick(SIDE_TAGS[:6]) if kind == 0 else f"{pick(['div', 'div', 'section', 'aside', 'ul', 'ol', 'p'])} {pick([name, name, name, f'{name} {pick(SIDE_NAMES)}', f'site-{name}', f'{name}-{pick(NAME_ENDS)}', f'{name}-{pick(MAIN_NAMES)}'])}"
        inner = pick([("ul", "li"), ("div",), ("p",), ("div", "p"), (), ("section", "p"), ("ol", "li"), ("label",), ("h3",)])
        blocks = []
        if rnd.random() < 0.4:
            blocks.append(((*above, top, pick(["h2", "h3", "h4"])), " ".join(pick(side).split()[:3]) or name, 0))
        for _ in range(int(rnd.integers(1, 7))):
            text = pick(prose) if rnd.random() < 0.5 else " ".join(pick(side).split()[: int(rnd.integers(1, 9))])
            if text:
                blocks.append(((*above, top, *inner), text, len(text) if "li" in inner and rnd.random() < 0.7 else 0))
        return blocks

    def dressed() -> str:
        name = pick(MAIN_NAMES)
        return pick(["article", "article", "main", f"div {name}", f"div {name} {pick(MAIN_NAMES)}", f"section {name}", f"article {name}", f"div {name}-{pick(NAME_ENDS)}", "div", "section"])

    for _ in range(n):
        above: tuple[str, ...] = pick([("html", "body"), ("body",), ("html", "body", "div"), ("html", "body", "div page"), ("html", "body", "div wrapper container"), ()])
        blocks, labels = [], []

        def add(new: list[Block], label: int) -> None:
            blocks.extend(new)
            labels.extend([label] * len(new))

        for _ in range(int(rnd.integers(0, 4))):
            add(part(above), 0)
        holder = (*above, *([pick(["main", "div main", "div content", "div"])] if rnd.random() < 0.3 else []), dressed())
        if rnd.random() < 0.7:
            heading = pick(["h1", "h1", "h2", f"{pick(['h1', 'h2'])} {pick(TITLE_NAMES)}"])
            add([((*holder, heading), " ".join(pick(prose).split()[: int(rnd.integers(1, 14))]) or "Title", 0)], 1)
        outer = holder
        if rnd.random() < 0.25:
            holder = (*holder, dressed())
        for _ in range(int(rnd.integers(1, 14))):
            inner = pick([("p",)] * 12 + [("h2",), ("h3",), ("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("pre",), ("table", "tr", "td"), ("figure", "figcaption"), ("div",), ("div", "p"), ("section", "p"), ()])
            text = pick(prose)
            text = " ".join(text.split()[: int(rnd.integers(1, 12))]) if rnd.random() < 0.25 else text
            if text:
                add([((*holder, *inner), text, int(len(text) * 0.1) if rnd.random() < 0.2 else 0)], 1)
            if rnd.random() < 0.12:
                add(part(holder, True), 0)
        if rnd.random() < 0.6:
            add(part(pick([holder, outer]), True), 0)
        for _ in range(int(rnd.integers(0, 4))):
            add(part(above), 0)
        if blocks:
            yield blocks, np.array(labels)


def trained(pages: list[str | None]) -> Labeller:
    """A labeller taught by the markup of the pages and by invented layouts of their blocks."""
    rnd = np.random.default_rng(SEED)
    sequences, labels, prose, side = [], [], [], []
    for blocks in filter(None, map(blocks_of, pages)):
        known = [taught(path) for path, _, _ in blocks]
        prose += [t for (_, t, _), k in zip(blocks, known) if k == 1]
        side += [t for (_, t, _), k in zip(blocks, known) if k == 0]
        if None not in known:
            sequences += [blocks] * 2
            labels += [np.array(known)] * 2
    prose, side = prose or ["Some words of a page."], side or ["Home", "About us"]
    for blocks, known in layouts(rnd, prose, side, LAYOUTS * TRAIN_PAGES):
        sequences.append(blocks)
        labels.append(known)
    labeller = Labeller()
    labeller.train(sequences, labels)
    return labeller


def labeller_of(pages: DataFrame) -> Labeller:
    """The labeller trained in one task on a bounded sample; only its weights reach the driver."""

    def train(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = list(groups)
        if not frames:
            return
        sample = pd.concat(frames, ignore_index=True).sort_values(["h", "html"], kind="stable")
        yield pd.DataFrame({"weights": [pickle.dumps(trained(sample["html"].tolist()).weights)]})

    short = pages.select(F.xxhash64("page_id").alias("h"), F.col("html").cast("string").alias("html")).where(F.length("html") <= TRAIN_CHARS)
    sample = short.orderBy("h", "html").limit(TRAIN_PAGES).repartition(1)
    found = sample.mapInPandas(train, "weights binary").collect()
    labeller = Labeller()
    if found:
        labeller.weights = pickle.loads(bytes(found[0].weights))
    return labeller


def main_text(blocks: list[Block], main: np.ndarray) -> str:
    return "\n\n".join(text for (_, text, _), p in zip(blocks, main) if p > 0.5)


def texts_of(pages: list[str | None], labeller: Labeller) -> Iterator[str]:
    """The main text of every page; pages are labelled in groups of bounded size."""
    sizes = list(accumulate(len(p or "") for p in pages))
    start = 0
    while start < len(pages):
        limit = (sizes[start - 1] if start else 0) + GROUP_CHARS
        end = max(start + 1, int(np.searchsorted(sizes, limit, "right")))
        blocks = [blocks_of(p) for p in pages[start:end]]
        yield from map(main_text, blocks, labeller.probabilities(blocks))
        start = end


def extraction(labeller: Labeller) -> Callable:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(texts_of(batch.column(batch.num_columns - 1).to_pylist(), labeller))
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "text", "n_chars"])

    return extract


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (its main text), n_chars."""
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(extraction(labeller_of(pages)), f"{kinds}, text string, n_chars long")
