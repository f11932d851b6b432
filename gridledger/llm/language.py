"""Language identification by a byte convolutional network, trained here in numpy.

Lower-cased UTF-8 bytes are embedded; filters of two, three and four bytes run over windows of fixed length,
the largest response of each filter in a window is kept, and a softmax layer turns these into languages.
Every window of the whole text is classified; a text's probabilities are the mean of its windows', by bytes.

The learner sees a sample that is bounded by parameters (documents per language, windows per document, taken
at even steps through the whole text), collected to the driver. For prediction the trained filters are folded
into tables of byte pairs, so a position costs two row lookups.

Defined cases: a text that is null or has no letter is `und` with score 0, as is every text if nothing could
be learned; documents whose lang is `und` teach nothing; a single language is always predicted; a null doc_id is never learned from and not held out;
every row, repeated ones too, gives one row; an empty table gives no rows; other columns are not read, but
kept by accepted().
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import bound_batches, release_memory

UNKNOWN = "und"
#: Positions of a window; its filters look at up to three bytes beyond.
WINDOW = 253
REACH = 3
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
EMBEDDING = 8

#: A letter is of the Unicode categories Lu, Ll, Lt, Lm and Lo; numerals such as Ⅷ, ² and ① are none.
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# ---- windows ---------------------------------------------------------------------------------------------
def _padded(text: str) -> bytes:
    """Bytes of the text up to a whole number of windows, with at least REACH zeros."""
    raw = text.lower().encode("utf-8", "replace")
    return raw + bytes(REACH + (-len(raw) - REACH) % WINDOW)


def _window_weights(n_bytes: int, windows: int) -> np.ndarray:
    return np.clip(n_bytes - WINDOW * np.arange(windows), 1, WINDOW).astype(np.float64)


def _training_windows(per_document: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, windows = [], []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                if not _LETTER.search(text or ""):
                    continue
                raw = _padded(text)
                n = len(raw) // WINDOW
                for k in sorted({int(x) for x in np.linspace(0, n - 1, min(n, per_document))}):
                    langs.append(lang)
                    windows.append(raw[k * WINDOW : (k + 1) * WINDOW + REACH].ljust(WINDOW + REACH, b"\0"))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(windows, pa.binary())], names=["lang", "window"])

    return run


# ---- the network -----------------------------------------------------------------------------------------
@dataclass
class Network:
    """Languages in order, and the parameters: byte embedding, filters of each width, biases, softmax layer."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]  # width * EMBEDDING x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.out, self.out_bias]

    def forward(self, x: np.ndarray):
        """Pooled responses and where they were found, for windows x (n, WINDOW + REACH) of bytes."""
        e = self.embedding[x]
        pooled, where = [], []
        for w, k in zip(WIDTHS, self.filters):
            z = np.concatenate([e[:, j : j + WINDOW] for j in range(w)], axis=2) @ k
            at = z.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(z, at[:, None], 1)[:, 0])
        return np.maximum(np.concatenate(pooled, 1) + self.bias, 0), where

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy; only the pooled positions take part."""
        h, where = self.forward(x)
        p = softmax(h @ self.out + self.out_bias)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        dh = (p @ self.out.T) * (h > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters = []
        rows = np.arange(len(x))[:, None]
        for n, (w, k, at) in enumerate(zip(WIDTHS, self.filters, where)):
            g = dh[:, n * FILTERS : (n + 1) * FILTERS]
            seen = np.stack([x[rows, at + j] for j in range(w)], 2)  # n x FILTERS x w bytes
            patch = self.embedding[seen].reshape(len(x), FILTERS, -1)
            d_filters.append(np.einsum("nf,nfd->df", g, patch))
            np.add.at(d_embedding, seen, (g[:, :, None] * k.T).reshape(len(x), FILTERS, w, EMBEDDING))
        return [d_embedding, *d_filters, dh.sum(0), h.T @ p, p.sum(0)]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Filters folded into byte pairs: all widths at a pair, and what the longer ones add two bytes on."""
        two, three, four = (k.reshape(w, EMBEDDING, FILTERS) for w, k in zip(WIDTHS, self.filters))
        at = lambda k: (self.embedding @ k).astype(np.float32)
        pair = lambda a, b: (at(a)[:, None] + at(b)[None]).reshape(65536, FILTERS)
        first = np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], 1)
        then = np.concatenate([np.repeat(at(three[2]), 256, 0), pair(four[2], four[3])], 1)
        return np.ascontiguousarray(first), np.ascontiguousarray(then)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on shuffled batches; the same sample gives the same network."""
    rng = np.random.default_rng(seed)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32),
        rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            step += 1
            lr = rate * 0.5**epoch * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, (m, v) in zip(net.parameters, net.gradients(windows[part], labels[part]), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (lr * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return net


def learn(docs: DataFrame, documents_per_language: int = 1500, windows_per_document: int = 4, **options) -> Network | None:
    """A network from the documents that may be learned from; None if there are none.

    documents_per_language bounds the expected sample of each language, windows_per_document the windows of
    a document; a document is chosen by a hash of its id.
    """
    bound_batches(docs.sparkSession)
    may = docs.where((F.col("lang") != UNKNOWN) & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in may.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    chosen = F.lit(False)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 31))
    for lang in languages:
        chosen = chosen | ((F.col("lang") == lang) & (draw < int(min(1.0, documents_per_language / counts[lang]) * (1 << 31)) + 1))
    rows = may.where(chosen).select("lang", "text").mapInArrow(_training_windows(windows_per_document), "lang string, window binary").toArrow()
    if not rows.num_rows:
        return None
    sample = sorted(zip(rows["window"].to_pylist(), rows["lang"].to_pylist()))  # the order must not depend on the cluster
    windows = np.frombuffer(b"".join(w for w, _ in sample), np.uint8).reshape(-1, WINDOW + REACH)
    number = {lang: i for i, lang in enumerate(languages)}
    return train(windows, np.array([number[lang] for _, lang in sample]), languages, **options)


# ---- prediction ------------------------------------------------------------------------------------------
class Predictor:
    """Probabilities of texts, from the folded tables."""

    CHUNK = 64  # windows whose responses stay in a core's cache

    def __init__(self, net: Network):
        self._net = net
        self._first, self._then = net.tables()

    def window_probabilities(self, raw: bytes) -> np.ndarray:
        b = np.frombuffer(raw, np.uint8).astype(np.uint16)
        pairs = np.zeros(len(b) + 2, np.uint16)
        pairs[: len(b) - 1] = (b[:-1] << 8) | b[1:]
        n = len(raw) // WINDOW
        pooled = np.empty((n, FILTERS * len(WIDTHS)), np.float32)
        for i in range(0, n, self.CHUNK):
            a, z = i * WINDOW, min(n, i + self.CHUNK) * WINDOW
            r = self._first.take(pairs[a:z], axis=0)
            r[:, FILTERS:] += self._then.take(pairs[a + 2 : z + 2], axis=0)
            pooled[i : i + self.CHUNK] = r.reshape(-1, WINDOW, r.shape[1]).max(axis=1)
        return softmax(np.maximum(pooled + self._net.bias, 0) @ self._net.out + self._net.out_bias)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        known = [bool(t) and _LETTER.search(t) is not None for t in texts]
        parts = [_padded(t) for t, k in zip(texts, known) if k]
        if not parts:
            return [(UNKNOWN, 0.0)] * len(texts)
        p = self.window_probabilities(b"".join(parts)).astype(np.float64)
        out, at = iter(range(len(parts))), 0
        found = []
        for k in known:
            if not k:
                found.append((UNKNOWN, 0.0))
                continue
            raw = parts[next(out)]
            n = len(raw) // WINDOW
            w = _window_weights(len(raw.rstrip(b"\0")), n)
            mean = w @ p[at : at + n] / w.sum()
            at += n
            best = int(mean.argmax())
            found.append((self._net.languages[best], min(1.0, float(mean[best]))))
        return found


_TEXT_BYTES = 1 << 20


def _predictions(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net) if net else None
        for batch in batches:
            found: list[tuple[str, float]] = []
            texts: list[str | None] = []
            size = 0
            for x in batch["text"]:
                text = x.as_py()
                texts.append(text)
                size += len(text or "")
                if size >= _TEXT_BYTES:
                    found += predictor.predict(texts) if predictor else [(UNKNOWN, 0.0)] * len(texts)
                    texts, size = [], 0
            found += predictor.predict(texts) if predictor else [(UNKNOWN, 0.0)] * len(texts)
            keep = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            lang, score = ([f[i] for f in found] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*(batch.schema.names[i] for i in keep), "lang_pred", "score"],
            )
            release_memory()

    return run


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(_predictions(net), "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """Learns from the documents that aren't held out, and predicts all of them."""
    return predict(docs, learn(docs, **options))


def _accepting(net: Network | None, least_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net) if net else None
        for batch in batches:
            keep: list[bool] = []
            for i in range(0, batch.num_rows, 256):
                texts = batch["text"].slice(i, 256).to_pylist()
                found = predictor.predict(texts) if predictor else [(UNKNOWN, 0.0)] * len(texts)
                keep += [lang != UNKNOWN and score >= least_score for lang, score in found]
            yield batch.filter(pa.array(keep, pa.bool_()))
            release_memory()

    return run


def accepted(docs: DataFrame, least_score: float = 0.3, **options) -> DataFrame:
    """The rows of docs in a learned language; goes what is `und`, or for which no language reaches least_score."""
    return docs.mapInArrow(_accepting(learn(docs, **options), least_score), docs.schema)
