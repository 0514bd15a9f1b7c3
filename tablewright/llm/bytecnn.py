"""Quality classifier: a byte-level convolutional network in numpy.

The whole text is read as UTF-8 bytes. Filters of ``width`` bytes slide over it; their responses are pooled by maximum over
overlapping chunks (``chunk`` blocks of ``block`` positions each, starting every ``hop`` blocks) that cover the document to its last byte. The mean and
the maximum of the chunks' pooled responses feed one logistic unit.

A filter is a table of 256 responses per position of its window, so a response is a sum of ``width`` look-ups.
Training runs on a bounded sample of labelled documents (``max_rows``), each represented by at most ``max_chunks`` chunks spread
over it, and is deterministic. Scoring is a scan without shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import batch_rows, sampled, text_batches

WIDTH, FILTERS, BLOCK, CHUNK, HOP = 5, 16, 64, 8, 6
PIECE = 1 << 20  # bytes of texts that are laid side by side
STEP = 1 << 13  # bytes whose responses are held at once, small enough for the processor's cache


@dataclass
class ByteCNN:
    """``table``: (width, 256, filters); ``bias``: (filters,); ``dense``: (2 * filters,) and ``offset`` of the logistic unit."""

    table: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: float

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Maximum response of each filter in each block of ``data``, whose length is a multiple of ``BLOCK``."""
        n = len(data)
        padded = np.concatenate([data, np.zeros(WIDTH - 1, np.uint8)])
        total = np.take(self.table[0], padded[:n], axis=0)
        part = np.empty_like(total)
        for w in range(1, WIDTH):
            np.take(self.table[w], padded[w:w + n], axis=0, out=part, mode="clip")
            total += part
        return total.reshape(n // BLOCK, BLOCK, FILTERS).max(axis=1)

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Mean and maximum over the chunks of each text, (texts, 2 * filters)."""
        result = np.empty((len(texts), 2 * FILTERS), np.float32)
        for group in _groups(texts):
            sizes = [max(1, -(-len(texts[i]) // BLOCK)) for i in group]
            # An empty block after each text, so that no window reads into the next one.
            data = np.zeros((sum(sizes) + len(sizes)) * BLOCK, np.uint8)
            at = 0
            for i, size in zip(group, sizes):
                data[at:at + len(texts[i])] = np.frombuffer(texts[i], np.uint8)
                at += (size + 1) * BLOCK
            # Pieces overlap by one block, so that windows across the cut are whole.
            blocks = np.concatenate([self.responses(data[p:p + STEP + BLOCK])[:STEP // BLOCK] for p in range(0, len(data), STEP)])
            at = 0
            for i, size in zip(group, sizes):
                result[i] = _pool(blocks[at:at + size])
                at += size + 1
        return result

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1."""
        hidden = np.maximum(self.features(texts) + np.tile(self.bias, 2), 0)
        return 1.0 / (1.0 + np.exp(-(hidden.astype(np.float64) @ self.dense + self.offset)))


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Runs of texts of about ``PIECE`` bytes together."""
    group, size = [], 0
    for i, text in enumerate(texts):
        if group and size + len(text) > PIECE:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(text) + BLOCK
    if group:
        yield group


def _starts(n_blocks: int) -> np.ndarray:
    """First blocks of the chunks of a document; the last chunk ends with the document."""
    if n_blocks <= CHUNK:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n_blocks - CHUNK, HOP)
    return np.append(starts, n_blocks - CHUNK)


def _pool(blocks: np.ndarray) -> np.ndarray:
    starts = _starts(len(blocks))
    pooled = blocks[starts]
    for k in range(1, min(CHUNK, len(blocks))):
        pooled = np.maximum(pooled, blocks[starts + k])
    return np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)])


def training_chunks(text: bytes, max_chunks: int) -> list[bytes]:
    """At most ``max_chunks`` chunks spread evenly over the text, each of ``CHUNK * BLOCK`` bytes, zero filled at the end."""
    n_blocks = max(1, -(-len(text) // BLOCK))
    starts = _starts(n_blocks)
    if len(starts) > max_chunks:
        starts = starts[np.linspace(0, len(starts) - 1, max_chunks).round().astype(int)]
    size = CHUNK * BLOCK
    return [text[s * BLOCK:s * BLOCK + size].ljust(size, b"\0") for s in starts]


def train(samples: list[tuple[int, list[bytes]]], epochs: int = 8, rate: float = 0.01, seed: int = 7, batch: int = 32) -> ByteCNN:
    """Fit on (label, chunks) pairs by Adam on the class-balanced log loss; the same samples in the same order give the same model.

    Samples of a single class, or none, give a constant score of that class (0.5 for none).
    """
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
    bias = np.zeros(FILTERS, np.float32)
    dense = rng.normal(0, 0.2, 2 * FILTERS).astype(np.float64)
    labels = np.array([y for y, _ in samples], np.float64)
    if len(set(labels.tolist())) < 2:
        constant = 0.0 if not len(labels) else 6.0 * (2 * labels[0] - 1)
        return ByteCNN(table, bias, np.zeros(2 * FILTERS), float(constant))
    offset = np.zeros(1)
    data = [np.frombuffer(b"".join(c), np.uint8).reshape(len(c), -1) for _, c in samples]
    weight = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    params = [table, bias, dense, offset]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    positions = CHUNK * BLOCK - WIDTH + 1
    for epoch in range(epochs):
        order = rng.permutation(len(samples))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            chunks = np.concatenate([data[i] for i in rows])
            owner = np.repeat(np.arange(len(rows)), [len(data[i]) for i in rows])
            total = np.take(table[0], chunks[:, :positions], axis=0)
            for w in range(1, WIDTH):
                total += np.take(table[w], chunks[:, w:w + positions], axis=0)
            place = total.argmax(axis=1)  # (chunks, filters)
            pooled = np.take_along_axis(total, place[:, None, :], axis=1)[:, 0]
            count = np.bincount(owner, minlength=len(rows))[:, None]
            starts = np.concatenate([[0], np.cumsum(count[:-1, 0])])
            mean = np.add.reduceat(pooled, starts, axis=0) / count
            top = np.maximum.reduceat(pooled, starts, axis=0)
            raw = np.concatenate([mean, top], axis=1) + np.tile(bias, 2)
            hidden = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-(hidden @ dense + offset[0])))
            slope = (p - labels[rows]) * weight[rows] / len(rows)
            g_hidden = slope[:, None] * dense * (raw > 0)
            g_mean, g_top = g_hidden[:, :FILTERS] / count, g_hidden[:, FILTERS:]
            g_pooled = g_mean[owner] + g_top[owner] * (pooled == top[owner])
            g_table = np.zeros(table.shape, np.float64)
            filters = np.broadcast_to(np.arange(FILTERS), place.shape)
            for w in range(WIDTH):
                byte = np.take_along_axis(chunks, place + w, axis=1)
                np.add.at(g_table[w], (byte, filters), g_pooled)
            grads = [g_table, (g_hidden[:, :FILTERS] + g_hidden[:, FILTERS:]).sum(axis=0), hidden.T @ slope + 1e-4 * dense,
                     np.array([slope.sum()])]
            t += 1
            step = rate * (0.5 ** (epoch // 3))
            for param, grad, m, v in zip(params, grads, first, second):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return ByteCNN(table, bias, dense, float(offset[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_on: Column | None,
                    max_rows: int, max_chunks: int) -> list[tuple[int, list[bytes]]]:
    """About ``max_rows`` labelled documents at most, by a hash of the id, each as its training chunks; of rows with the same id and label, the least text.

    At most ``max_rows * max_chunks`` chunks of ``CHUNK * BLOCK`` bytes reach the driver.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    if train_on is not None:
        known = known.where(train_on)
    total = known.count()
    if total > max_rows:
        known = known.where(sampled(F.col("id"), max_rows, total))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(known, "id").groupBy("id", "label").agg(
        F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            chunks = [training_chunks(t or b"", max_chunks) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.string()), batch.column("label"), pa.array(chunks, pa.list_(pa.binary()))],
                                             names=["id", "label", "chunks"])

    found = rows.mapInArrow(run, "id string, label int, chunks array<binary>").toArrow()
    picked = sorted(zip(found["id"].to_pylist(), found["label"].to_pylist(), found["chunks"].to_pylist()), key=lambda r: (r[0], r[1], r[2]))
    return [(int(label > 0), chunks) for _, label, chunks in picked]


def apply_scores(df: DataFrame, model: ByteCNN, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """``keep`` and ``score`` for each row; NULL text counts as empty."""
    batch_rows(df.sparkSession, 500)
    kept_names = list(keep)
    chosen = df.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).cast("string").alias("__text"))
    schema = chosen.drop("__text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "__text"):
            scores = model.scores([t or b"" for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in kept_names] + [pa.array(scores, pa.float64())], names=[*kept_names, "score"])

    return chosen.mapInArrow(run, schema)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                     train_on: Column | None = None, max_rows: int = 4000, max_chunks: int = 12, keep: dict[str, Column] | None = None,
                     **training) -> DataFrame:
    """Train on labelled rows of ``docs`` and score all of them: ``keep`` (the id by default) and ``score`` in 0 to 1.

    ``train_on`` is a condition on the labels' column ``id``. ``max_rows`` and ``max_chunks`` bound the training sample only;
    scores read whole texts. NULL and empty texts get the score of no bytes, equal texts equal scores. Rows
    with NULL ids are scored but not trained on; NULL labels are left out. No labelled row gives 0.5 throughout. Repeated rows are scored each. Other columns do
    not matter, but ``keep`` may not name one ``__text``. An empty ``docs`` gives an empty result.
    """
    batch_rows(docs.sparkSession, 500)
    model = train(labelled_sample(docs, labels, id_col, text_col, label_col, train_on, max_rows, max_chunks), **training)
    return apply_scores(docs, model, text_col, keep or {id_col: F.col(id_col)})
