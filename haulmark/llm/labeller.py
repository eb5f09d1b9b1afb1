"""Recurrent block labeller: which blocks of a page belong to its main text.

A bidirectional LSTM in numpy reads the blocks of a page in order. Each is a vector of
hashed tag-path words, hashed words of the text and a few measures; every block is
classified from the states of both directions, so from all blocks before and after it.

There are no labelled pages, so the labeller learns from pages whose markup says what is what (an
``article`` or ``main`` element and page furniture around it): ``SAMPLE`` pages of least hash
of id and content, of at most ``SAMPLE_BYTES`` bytes. In training some paths are hidden, so that words, measures
and neighbours are learned from too. Every page is labelled, whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulmark.llm import words as W
from haulmark.llm.blocks import Block, blocks_of
from haulmark.llm.common import each, ship

SAMPLE, SAMPLE_BYTES = 240, 1 << 14
PATH, WORDS, MEASURES, HIDDEN = 64, 48, 8, 20
WIDTH = PATH + WORDS + MEASURES

# Words of tags, classes, ids and roles that mark main text and page furniture.
_MAIN = frozenset("article main".split())
_FURNITURE = frozenset("""nav header footer aside form menu sidebar ad ads advert advertisement banner cookie consent notice
    comment comments respond share social related breadcrumb pagination head title button select option promo sponsored
    newsletter subscribe popup modal widget login""".split())


def weak_labels(blocks: list[Block]) -> np.ndarray:
    """1 for blocks inside main text markup and outside of furniture within it, else 0."""
    out = np.zeros(len(blocks))
    for k, b in enumerate(blocks):
        names = [p.split(".") for p in b.path]
        inner = next((i for i in range(len(names) - 1, -1, -1) if _MAIN & set(names[i])), None)
        out[k] = inner is not None and not any(_FURNITURE & set(n) for n in names[inner:])
    return out


def _slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % size


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block: its path, its words as hashed shares, and measures of its text."""
    out = np.zeros((len(blocks), WIDTH), np.float32)
    paths: dict[tuple[str, ...], np.ndarray] = {}
    for k, b in enumerate(blocks):
        if b.path not in paths:
            row = np.zeros(PATH, np.float32)
            for label in b.path:
                for word in label.split("."):
                    row[_slot(word, PATH)] = 1
            row[_slot("last " + (b.path[-1] if b.path else ""), PATH)] += 1
            paths[b.path] = row
        out[k, :PATH] = paths[b.path]
    hashes, first = W.rows_hashes(pa.array([b.text for b in blocks], pa.string()))
    words = np.maximum(np.diff(first), 1)
    cell = np.repeat(np.arange(len(blocks)), np.diff(first)) * WORDS + (hashes % np.uint64(WORDS)).astype(np.int64)
    count = np.bincount(cell, minlength=len(blocks) * WORDS).reshape(len(blocks), WORDS)
    out[:, PATH:PATH + WORDS] = count / np.sqrt(words)[:, None]
    n = np.array([len(b.text) for b in blocks])
    out[:, PATH + WORDS:] = np.stack([
        np.log1p(n) / 8, np.log1p(words) / 6, np.array([b.linked for b in blocks]) / n, np.array([b.text[-1] in ".!?" for b in blocks]),
        n < 25, n > 100, np.arange(len(blocks)) / len(blocks), np.ones(len(blocks))], axis=1)
    return out


class Labeller:
    """Weights of both directions (input, recurrent, bias for the four gates) and of the output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w = {}
        for d in "fb":
            self.w[d + "x"] = rng.normal(0, 0.15, (WIDTH, 4 * HIDDEN)).astype(np.float32)
            self.w[d + "h"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1  # remember at first
            self.w[d + "b"] = bias
        self.w["o"] = rng.normal(0, 0.15, (2 * HIDDEN,)).astype(np.float32)
        self.w["ob"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States (steps, pages, HIDDEN) of one direction; padding leaves the state as it is."""
        steps, pages = mask.shape
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        given = x @ self.w[d + "x"] + self.w[d + "b"]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        saved = {}
        for t in order:
            z = given[t] + h @ self.w[d + "h"]
            g = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = g[:, :HIDDEN], g[:, HIDDEN:2 * HIDDEN], g[:, 2 * HIDDEN:]
            u = np.tanh(z[:, 3 * HIDDEN:])
            c2 = f * c + i * u
            tc = np.tanh(c2)
            m = mask[t][:, None]
            if keep:
                saved[t] = (h, c, i, f, o, u, tc, m)
            h, c = np.where(m, o * tc, h), np.where(m, c2, c)
            out[t] = h
        return out, saved

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        f, _ = self._run(x, mask, "f", False)
        b, _ = self._run(x, mask, "b", False)
        return _sigmoid(f @ self.w["o"][:HIDDEN] + b @ self.w["o"][HIDDEN:] + self.w["ob"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the blocks, by back-propagation through time."""
        f, fs = self._run(x, mask, "f", True)
        b, bs = self._run(x, mask, "b", True)
        p = _sigmoid(f @ self.w["o"][:HIDDEN] + b @ self.w["o"][HIDDEN:] + self.w["ob"])
        e = (p - y) * mask / max(1, mask.sum())
        grad = {"o": np.concatenate([(f * e[..., None]).sum((0, 1)), (b * e[..., None]).sum((0, 1))]), "ob": np.array([e.sum()])}
        for d, saved, part in (("f", fs, self.w["o"][:HIDDEN]), ("b", bs, self.w["o"][HIDDEN:])):
            steps, pages = mask.shape
            order = range(steps - 1, -1, -1) if d == "f" else range(steps)
            dz = np.zeros((steps, pages, 4 * HIDDEN), np.float32)
            dh, dc = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
            gh = np.zeros_like(self.w[d + "h"])
            for t in order:
                h, c, i, fg, o, u, tc, m = saved[t]
                dh = dh + e[t][:, None] * part
                own = np.where(m, dh, 0)
                dct = np.where(m, dc, 0) + own * o * (1 - tc * tc)
                z = np.concatenate([dct * u * i * (1 - i), dct * c * fg * (1 - fg), own * tc * o * (1 - o), dct * i * (1 - u * u)], axis=1)
                dz[t] = z
                gh += h.T @ z
                dh = z @ self.w[d + "h"].T + np.where(m, 0, dh)
                dc = dct * fg + np.where(m, 0, dc)
            grad[d + "h"] = gh
            grad[d + "x"] = np.einsum("tpw,tpz->wz", x, dz, optimize=True)
            grad[d + "b"] = dz.sum((0, 1))
        return grad


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors (steps, pages, WIDTH) and which of them are there."""
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, True
    return x, mask


def fit(pages: list[list[Block]], epochs: int = 10, batch: int = 16, rate: float = 0.01, hide: float = 0.15, seed: int = 7) -> Labeller:
    """Adam over shuffled batches of pages; without pages the labeller keeps its first weights."""
    model, rng = Labeller(seed), np.random.default_rng(seed)
    data = [(vectors(p), weak_labels(p)) for p in pages if p]
    first = {k: np.zeros(v.shape) for k, v in model.w.items()}
    second = {k: np.zeros(v.shape) for k, v in model.w.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), batch):
            some = [data[k] for k in order[a:a + batch]]
            x, mask = padded([v for v, _ in some])
            y = np.zeros(mask.shape)
            for k, (_, labels) in enumerate(some):
                y[:len(labels), k] = labels
            hidden = rng.random(mask.shape) < hide
            x[hidden, :PATH] = 0
            step += 1
            for k, g in model.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                size = (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                model.w[k] = (model.w[k] - rate * size).astype(np.float32)
    return model


def train(pages: DataFrame, sample: int = SAMPLE, largest: int = SAMPLE_BYTES, id_col: str = "page_id", html_col: str = "html") -> Labeller:
    """Fit on the bounded sample that the module names; it is the only thing the driver gets."""
    html = F.col(html_col)
    rows = (pages.select(F.col(id_col).alias("id"), html.alias("html")).where("html is not null")
            .where(F.octet_length("html") <= largest).where(F.col("html").rlike("(?i)<(article|main)[ >]")))
    # only pages below a limit on the hash go to the driver, so what it gets doesn't grow with the table; the
    # limit is raised until there are enough
    places, total = 1 << 62, max(1, pages.count())
    limit, some = 3 * sample / total, []
    while True:
        place = F.pmod(F.xxhash64("id", "html"), F.lit(places))
        some = (rows.withColumn("place", place).where(F.col("place") < min(places, int(places * limit)))
                .orderBy("place", "id", F.xxhash64("html")).limit(sample).collect())
        if len(some) >= sample or limit >= 1:
            return fit([blocks_of(r["html"]) for r in some])
        limit *= 4


#: Steps times pages of a batch when labelling.
_CELLS = 20_000


def main_texts(pages: list[list[Block]], model: Labeller) -> list[str]:
    """The main text of each page: its blocks labelled so, one to a line."""
    out = [""] * len(pages)
    order = sorted((k for k, p in enumerate(pages) if p), key=lambda k: len(pages[k]))
    a = 0
    while a < len(order):
        b = a + 1
        while b < len(order) and (b - a + 1) * len(pages[order[b]]) <= _CELLS:
            b += 1
        some = order[a:b]
        x, mask = padded([vectors(pages[k]) for k in some])
        keep = model.scores(x, mask) >= 0.5
        for column, k in enumerate(some):
            out[k] = "\n".join(blk.text for blk, yes in zip(pages[k], keep[:, column]) if yes)
        a = b
    return out


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in each(batches):
            for part in W.slices(batch, "html", 1 << 20):
                texts = main_texts([blocks_of(h) for h in part.column(2).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])
    return run


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html).

    text is empty if no block is labelled main text, as for null or empty html; null ids and
    urls and repeated rows are passed on; an empty table gives none.
    """
    spark = ship(pages.sparkSession)
    shared = spark.sparkContext.broadcast(model or train(pages))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return (rows.mapInArrow(_extract(shared), "page_id long, url string, text string")
            .withColumn("n_chars", F.char_length("text").cast("long")))
