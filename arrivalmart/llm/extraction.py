"""The main text of HTML pages by a recurrent block labeller.

A page is a sequence of blocks. Each block becomes a vector of its hashed tag path, its hashed words and a few measurements; a
bidirectional LSTM reads the whole sequence from both ends, so each block is labelled in the light of all others, and the blocks
labelled main are joined. The network is written in numpy and trained here, on pages generated from a grammar of layouts, where
the role of each block is known. The grammar's texts are made of random syllables, so it learns from structure and from the
stock phrases of menus, notices and the like.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivalmart.llm.blocks import PATH, Block, blocks_of
from arrivalmart.llm.texts import bytes_of, coded_words, column, parts_of

WORDS, SIZES = 48, 6
INPUT = PATH + WORDS + SIZES
HIDDEN = 20
TRAINED_ON = 1000  # generated pages
EPOCHS = 16
SEED = 7


# Vectors


def _word_buckets(words: pa.StringArray) -> np.ndarray:
    """A bucket for each word, by its letters and their places; signs at its ends don't count."""
    if not len(words):
        return np.zeros(0, dtype=np.int64)
    data, offsets = bytes_of(words)
    place = (np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.uint64)
    own = np.where((data >= 0x61) | ((data >= 0x30) & (data < 0x3A)), data, 0).astype(np.uint64) * (place * np.uint64(2654435761) + np.uint64(40503))
    return ((np.add.reduceat(own, offsets[:-1]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % WORDS


class Vectors:
    """The vectors of many blocks in parts: a row for each distinct path, and words and sizes for each block."""

    def __init__(self, blocks: list[Block]):
        numbers: dict[int, int] = {}
        self.path = np.array([numbers.setdefault(b.path, len(numbers)) for b in blocks], dtype=np.int64)
        self.paths = np.zeros((len(numbers), PATH), dtype=np.float32)
        for path, k in numbers.items():
            self.paths[k, [bit for bit in range(PATH) if path >> bit & 1]] = 1
        texts = pa.array([b.text for b in blocks], pa.string())
        codes, distinct, offsets = coded_words(pc.utf8_lower(texts))
        buckets = _word_buckets(distinct)
        counts = np.diff(offsets)
        lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        sums = np.zeros((len(blocks), WORDS))
        if len(codes):
            owner = np.repeat(np.arange(len(blocks)), counts)
            sums = np.bincount(owner * WORDS + buckets[codes], minlength=len(blocks) * WORDS).reshape(len(blocks), WORDS)
        commas = sum(pc.count_substring(texts, sign).to_numpy(zero_copy_only=False) for sign in ".,;")
        sizes = [
            np.log1p(lengths) / 5,
            np.log1p(counts) / 4,
            np.minimum(np.array([b.linked for b in blocks]) / np.maximum(lengths, 1), 1),
            pc.match_substring_regex(texts, "[.!?]$").to_numpy(zero_copy_only=False),
            commas / np.maximum(counts, 1),
            np.ones(len(blocks)),
        ]
        self.rest = np.concatenate((sums / np.maximum(2 * counts, 8)[:, None], np.stack(sizes, axis=1)), axis=1).astype(np.float32)

    def whole(self) -> np.ndarray:
        return np.concatenate((self.paths[self.path], self.rest), axis=1)

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The vectors times a matrix; each distinct path is multiplied once."""
        return (self.paths @ weights[:PATH])[self.path] + self.rest @ weights[PATH:]


# The network


def new_network(seed: int = SEED) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    found = {}
    for way in ("f", "b"):
        found[f"{way}.x"] = draw.normal(0, 0.15, (INPUT, 4 * HIDDEN))
        found[f"{way}.h"] = draw.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
        found[f"{way}.c"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)  # input, forget, output, candidate
    found["out"] = draw.normal(0, 0.15, 2 * HIDDEN)
    found["out.c"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in found.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(net: dict, way: str, gates: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (pages, steps, HIDDEN) of one direction from its products with the vectors; where the mask is off the state stays."""
    pages, steps, _ = gates.shape
    gates = gates + net[f"{way}.c"]
    h, c = np.zeros((pages, HIDDEN), dtype=np.float32), np.zeros((pages, HIDDEN), dtype=np.float32)
    states, kept = np.zeros((pages, steps, HIDDEN), dtype=np.float32), []
    for t in range(steps):
        z = gates[:, t] + h @ net[f"{way}.h"]
        ifo, g = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
        m = mask[:, t, None]
        new = f * c + i * g
        out = o * np.tanh(new)
        if keep:
            kept.append((h, c, i, f, o, g, new, m))
        c, h = np.where(m, new, c), np.where(m, out, h)
        states[:, t] = h
    return states, kept


def _backward(net: dict, way: str, x: np.ndarray, slopes: np.ndarray, kept: list) -> dict[str, np.ndarray]:
    """Gradients of one direction from those of its states."""
    dh, dc = np.zeros_like(slopes[:, 0]), np.zeros_like(slopes[:, 0])
    dz_all = np.zeros((*slopes.shape[:2], 4 * HIDDEN), dtype=np.float32)
    dwh = np.zeros_like(net[f"{way}.h"])
    for t in range(slopes.shape[1] - 1, -1, -1):
        h, c, i, f, o, g, new, m = kept[t]
        dh = dh + slopes[:, t]
        tanh = np.tanh(new)
        inner = np.where(m, dh * o * (1 - tanh**2) + dc, 0)
        dz = np.concatenate((inner * g * i * (1 - i), inner * c * f * (1 - f), np.where(m, dh * tanh, 0) * o * (1 - o), inner * i * (1 - g**2)), axis=1)
        dz_all[:, t] = dz
        dwh += h.T @ dz
        dh, dc = np.where(m, dz @ net[f"{way}.h"].T, dh), np.where(m, inner * f, dc)
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return {f"{way}.x": x.reshape(-1, INPUT).T @ flat, f"{way}.h": dwh, f"{way}.c": flat.sum(axis=0)}


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((len(pages), steps, pages[0].shape[1]), dtype=np.float32), np.zeros((len(pages), steps), dtype=bool)
    for k, page in enumerate(pages):
        x[k, : len(page)], mask[k, : len(page)] = page, True
    return x, mask


def _logits(net: dict, ahead: np.ndarray, back: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Of each block of each page, from the products of both directions with the vectors in page order."""
    states_f, kept_f = _forward(net, "f", ahead, mask, keep)
    states_b, kept_b = _forward(net, "b", back[:, ::-1], mask[:, ::-1], keep)
    both = np.concatenate((states_f, states_b[:, ::-1]), axis=2)
    return both @ net["out"] + net["out.c"], (both, kept_f, kept_b)


def label_pages(net: dict, blocks: Vectors, counts: list[int], cells: int = 50_000) -> list[np.ndarray]:
    """For each page, of so many blocks, whether each is main; pages of like length are read together, `cells` blocks at most or one page."""
    found: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(counts)
    gates = np.concatenate([blocks.times(net[f"{way}.x"]) for way in ("f", "b")], axis=1)
    begins = np.cumsum(counts) - counts
    order = sorted((k for k in range(len(counts)) if counts[k]), key=lambda k: counts[k], reverse=True)
    at = 0
    while at < len(order):
        some = order[at : at + max(1, min(512, cells // counts[order[at]]))]
        at += len(some)
        x, mask = _padded([gates[begins[k] : begins[k] + counts[k]] for k in some])
        logits, _ = _logits(net, x[:, :, : 4 * HIDDEN], x[:, :, 4 * HIDDEN :], mask)
        for row, k in enumerate(some):
            found[k] = logits[row, : counts[k]] > 0
    return found


def train(samples: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """A network fitted to pages and the labels of their blocks, by Adam over shuffled batches."""
    net, draw = new_network(seed), np.random.default_rng(seed)
    first, second = {k: np.zeros_like(v) for k, v in net.items()}, {k: np.zeros_like(v) for k, v in net.items()}
    step = 0
    for epoch in range(epochs):
        order = draw.permutation(len(samples))
        for a in range(0, len(order), 32):
            some = [samples[k] for k in order[a : a + 32]]
            x, mask = _padded([v for v, _ in some])
            # Parts of the input are left out at random, so that no single tag or word decides alone.
            left = draw.random((len(some), 1, INPUT)) > 0.08
            left[:, :, PATH : PATH + WORDS] &= draw.random((len(some), 1, 1)) > 0.4
            x *= left
            y = np.zeros(mask.shape, dtype=np.float32)
            for k, (_, own) in enumerate(some):
                y[k, : len(own)] = own
            logits, (both, kept_f, kept_b) = _logits(net, x @ net["f.x"], x @ net["b.x"], mask, True)
            error = np.where(mask, _sigmoid(logits) - y, 0) / mask.sum()
            slopes = error[:, :, None] * net["out"]
            grads = {"out": np.einsum("pt,pth->h", error, both), "out.c": error.sum(keepdims=True).ravel()}
            grads |= _backward(net, "f", x, slopes[:, :, :HIDDEN], kept_f)
            grads |= _backward(net, "b", x[:, ::-1], slopes[:, ::-1, HIDDEN:], kept_b)
            step += 1
            rate = 0.01 * (1 - 0.8 * epoch / epochs)
            for k, slope in grads.items():
                slope = slope + 1e-5 * net[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                net[k] = (net[k] - rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


# Generated pages

# Names that say what an element is for; each stands alone or beside another word.
NOISE = {
    "menu": ("nav menu navbar navigation breadcrumb breadcrumbs pagination toc topbar tabs links", "Home|About us|Contact|Products|Sign in|Next page|Previous|All topics|Search"),
    "header": ("header masthead banner logo branding top tagline", "Welcome|The daily news|Official site|Sign in|Subscribe"),
    "footer": ("footer foot bottom copyright colophon legal imprint", "© 2024 All rights reserved.|Privacy policy|Terms of use|Imprint|Powered by"),
    "sidebar": ("sidebar aside widget related recommended recent trending popular archive tags", "Related articles|Most read|You may also like|Recent posts|Tags|Trending now"),
    "notice": ("notice cookie cookies consent gdpr alert popup modal overlay disclaimer message paywall", "We use cookies to improve this site.|Accept all|Please enable JavaScript.|Your session has expired."),
    "advert": ("ad ads advert advertisement sponsor sponsored promo promotion commercial adsense partner", "Advertisement|Sponsored content|Buy now and save|Limited offer"),
    "form": ("form login signup subscribe newsletter search register feedback", "Your email address|Subscribe|Submit|Password|Sign up for our newsletter"),
    "comments": ("comments comment reply replies discussion respond reviews disqus", "3 comments|Reply|Great article, thanks!|Leave a comment|said on Monday"),
    "share": ("share social follow sharing buttons tools", "Share this|Tweet|Follow us|Print|Email"),
}
MAIN = "content article post entry main body text story blog page maincontent articlebody".split()
WRAPPERS = "wrapper container page site layout row column inner outer wrap section".split()


def _text(draw: random.Random, words: int) -> str:
    syllables = ("an", "er", "the", "ou", "re", "st", "on", "que", "ie", "sch", "ar", "los", "ti", "é", "ent", "ing", "de", "la")
    found = ["".join(draw.choices(syllables, k=draw.randint(1, 3))) + draw.choice(["", "", "", "", "", ",", "."]) for _ in range(words)]
    style = draw.random()
    if style < 0.08:
        return " ".join(found[k - k % 12] for k in range(len(found)))
    if style < 0.16:
        return " | ".join(found).title()
    if style < 0.24:
        return "!! ".join(found).upper()
    if style < 0.32:
        return " ".join(w + draw.choice(["***", "&amp;&amp;", "###", "$$$", "%%"]) for w in found)
    return " ".join(found).capitalize() + draw.choice([".", "", "."])


def _noise(draw: random.Random, kind: str) -> list[tuple[str, bool | None]]:
    """Markup of a part that is not main, as (markup, None) and (text, label)."""
    names, phrases = NOISE[kind][0].split(), NOISE[kind][1].split("|")
    name = draw.choice(names)
    tag = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}.get(kind) if draw.random() < 0.5 else None
    mark = f' class="{draw.choice([name, name, f"{name}-{draw.choice(WRAPPERS)}", f"{draw.choice(WRAPPERS)} {name}"])}"'
    attributes = mark if tag is None or draw.random() < 0.3 else ""
    if draw.random() < 0.25 and attributes:
        attributes = attributes.replace("class", "id")
    outer = tag or draw.choice(["div", "div", "div", "section", "ul", "p", "table"])
    found: list[tuple[str, bool | None]] = [(f"<{outer}{attributes}>", None)]
    for _ in range(draw.choice([1, 1, 2, 3, 6])):
        text = draw.choice(phrases) if draw.random() < 0.4 else _text(draw, draw.choice([1, 1, 2, 4, 10, 30]) if kind != "menu" else 1)
        inner = draw.choice(["li", "li", "p"] if kind in ("menu", "sidebar") else ["p", "div", "span", "h3", "label" if kind == "form" else "p", ""])
        link = draw.random() < (0.85 if kind in ("menu", "share") else 0.25)
        found += [(f"<{inner}>" if inner else "", None), ('<a href="/x">' if link else "", None), (text, False), ("</a>" if link else "", None), (f"</{inner}>" if inner else "<hr>", None)]
    return [*found, (f"</{outer}>", None)]


def _main(draw: random.Random) -> list[tuple[str, bool | None]]:
    """Markup of the article, with parts inside it that are not main."""
    found: list[tuple[str, bool | None]] = []
    name = draw.choice(MAIN)
    tag, attributes = draw.choice([("article", ""), ("article", ""), ("article", f' class="{name}"'), ("main", ""), ("div", f' class="{name}"'), ("div", f' id="{name}"'), ("section", f' class="{name}-{draw.choice(MAIN)}"')])
    found.append((f"<{tag}{attributes}>", None))
    if draw.random() < 0.3:
        found += [("<header>", None), (f"<h1>{''}", None), (_text(draw, 6), True), ("</h1>", None), ("</header>", None)]
    elif draw.random() < 0.8:
        found += [("<h1>", None), (_text(draw, draw.choice([2, 6, 12])), True), ("</h1>", None)]
    for _ in range(draw.choice([1, 1, 2, 3, 5, 8, 14])):
        if draw.random() < 0.1:
            found += _noise(draw, draw.choice(["advert", "sidebar", "share", "form", "notice", "comments"]))
            continue
        inner = draw.choice(["p"] * 8 + ["h2", "h3", "li", "li", "li", "blockquote", "td", "pre", "div", "figcaption"])
        own = [(f"<{inner}>", None), (draw.choice(["", "", "<b>", "<em>", '<a href="/y">']), None), (_text(draw, draw.choice([1, 2, 3, 8, 20, 40, 80, 250])), True)]
        end = f"</{inner}>" if draw.random() < 0.9 else ""
        if "li" == inner:
            own, end = [("<ul>", None), *own], end + "</ul>"
        if "td" == inner:
            own, end = [("<table><tr>", None), *own], end + "</tr></table>"
        found += [*own, (end, None)]
    if draw.random() < 0.25:
        found += _noise(draw, draw.choice(["comments", "share", "sidebar", "advert"]))
    return [*found, (f"</{tag}>", None)]


def generated_page(draw: random.Random) -> tuple[str, list[bool]]:
    """A page and the label of each of its texts, in order."""
    before = draw.sample(["menu", "header", "notice", "advert", "form", "sidebar"], k=draw.randint(0, 4))
    after = draw.sample(["comments", "sidebar", "footer", "share", "advert", "notice", "menu", "form"], k=draw.randint(0, 5))
    parts: list[tuple[str, bool | None]] = [("<html><body>", None)]
    wraps = [f'<{draw.choice(["div", "section"])} class="{draw.choice(WRAPPERS)}">' for _ in range(draw.choice([0, 0, 1, 2]))]
    parts += [(w, None) for w in wraps]
    for kind in before:
        parts += _noise(draw, kind)
    parts += _main(draw) if draw.random() < 0.97 else []
    for kind in after:
        parts += _noise(draw, kind)
    parts += [(f"</{w[1:].split(' ')[0]}>", None) for w in reversed(wraps)]
    return "".join(markup for markup, _ in parts), [label for _, label in parts if label is not None]


def samples(pages: int = TRAINED_ON, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and labels of generated pages whose blocks are their texts one to one, as nearly all are."""
    draw, found = random.Random(seed), []
    while len(found) < pages:
        page, labels = generated_page(draw)
        blocks = blocks_of(page)
        if blocks and len(blocks) == len(labels):
            found.append((Vectors(blocks).whole(), np.array(labels, dtype=np.float32)))
    return found


@functools.cache
def trained() -> dict[str, np.ndarray]:
    return train(samples())


# Pages


def main_texts(net: dict, pages: list[str]) -> list[str]:
    """The main text of each page: its main blocks joined by an empty line; empty if it has none."""
    blocks = [blocks_of(page) for page in pages]
    marks = label_pages(net, Vectors([b for own in blocks for b in own]), [len(own) for own in blocks])
    return ["\n\n".join(b.text for b, main in zip(own, mark, strict=True) if main) for own, mark in zip(blocks, marks, strict=True)]


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",), net: dict | None = None) -> DataFrame:
    """Every row's id, the columns to keep, and its main text. A null page is empty; equal rows and null ids are kept."""
    net = net or trained()
    held = [id_col, *[c for c in keep if c in df.columns and c != id_col]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pages in parts_of(batch, html_col, 4 << 20):
                found = main_texts(net, pages.to_pylist())
                yield pa.RecordBatch.from_arrays([*[column(part, c) for c in held], pa.array(found, pa.string())], [*held, "text"])

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in held)
    # The page's own column may be named text as well, so the needed ones are taken first.
    found = df.select(*held, F.col(html_col)).mapInArrow(run, f"{kinds}, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
