"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound from its letters' vectors, the k-th rotated by n - 1 - k places, by
multiplication; a text is the bundle (sum) of its n-grams. A language's prototype is the bundle of its training texts at unit length, and
a text gets the language whose prototype is nearest by cosine, after the mean of all prototypes is taken out of both.

Training is one scan that sums vectors per task and language, in whole numbers so that the sums do not depend on their order,
and a combinable aggregate per (language, dimension). Prototypes, ``languages x dimensions`` numbers, reach the driver; ``max_languages``
bounds them. Scoring is a scan without shuffle. Both count n-grams first and bundle the counts by one matrix product
per batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import batch_rows, text_batches

DIMENSIONS = 1024
GRAM = 3
CLASSES = 128  # 0: no letter; 1 to 26: a to z; other letters share the rest by their code point
SCALE = 1 << 20  # of unit vectors, rounded to whole numbers
SIDE = 1 << 19  # code points counted at once
COLUMNS = 4096  # n-grams bundled at once
UNKNOWN = "und"


@cache
def _class_of() -> np.ndarray:
    """Class of every code point; a letter has the class of its lower case."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()[0]
            table[cp] = ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 2654435761 >> 8) % (CLASSES - 27)
    return table


@cache
def _letters(seed: int) -> np.ndarray:
    """(positions, classes, dimensions): the vector of each class, rotated for each place in an n-gram."""
    base = np.random.default_rng(seed).integers(0, 2, (CLASSES, DIMENSIONS)).astype(np.int8) * 2 - 1
    return np.stack([np.roll(base, GRAM - 1 - k, axis=1) for k in range(GRAM)])


def _grams(text: bytes) -> np.ndarray:
    """Codes of the n-grams of a text: lower-cased letters, anything else one blank, a blank at both ends.

    n-grams of blanks alone do not occur; a text without a letter has none.
    """
    classes = _class_of()[np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)]
    if not classes.any():
        return np.empty(0, np.int32)
    padded = np.concatenate([np.zeros(1, np.uint8), classes, np.zeros(1, np.uint8)])
    keep = (padded > 0) | np.append(True, padded[:-1] > 0)  # one blank per run
    c = padded[keep].astype(np.int32)
    return (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:]


def bundles(texts: list[bytes], seed: int = 11) -> np.ndarray:
    """(texts, dimensions): the bundle of each whole text; zeros without a letter."""
    letters = _letters(seed)
    result = np.zeros((len(texts), DIMENSIONS), np.float32)
    lo = 0
    while lo < len(texts):
        codes, hi, size = [], lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SIDE):
            codes.append(_grams(texts[hi]))
            size += len(texts[hi])
            hi += 1
        owner = np.repeat(np.arange(hi - lo), [len(c) for c in codes])
        distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
        for first in range(0, len(distinct), COLUMNS):
            some = distinct[first:first + COLUMNS]
            mine = (place >= first) & (place < first + len(some)) if len(distinct) > COLUMNS else slice(None)
            counts = np.bincount(owner[mine] * len(some) + place[mine] - first, minlength=(hi - lo) * len(some))
            a, b, c = some // CLASSES ** 2, some // CLASSES % CLASSES, some % CLASSES
            bound = (letters[0][a] * letters[1][b] * letters[2][c]).astype(np.float32)
            result[lo:hi] += counts.reshape(hi - lo, len(some)).astype(np.float32) @ bound
        lo = hi
    return result


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(length > 0, length, 1)


def prototypes(training: DataFrame, text_col: str, lang_col: str, max_languages: int) -> dict[str, np.ndarray]:
    """Unit prototype of each language of ``training``; rows without language or letters do not count."""
    batch_rows(training.sparkSession, 500)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush():
            langs = list(sums)
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([sums[k] for k in langs], pa.list_(pa.int64()))],
                                              names=["lang", "total"])

        for batch, texts in text_batches(batches, "text"):
            units = np.round(_unit(bundles([t or b"" for t in texts]).astype(np.float64)) * SCALE).astype(np.int64)
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs.tolist()):
                sums[lang] = sums.get(lang, 0) + units[langs == lang].sum(axis=0)
            if len(sums) > 256:
                yield flush()
                sums = {}
        if sums:
            yield flush()

    known = training.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    parts = known.mapInArrow(run, "lang string, total array<bigint>")
    totals = parts.select("lang", F.posexplode("total").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v"))
    found = vectors.select("lang", F.col("v.value").alias("v")).limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    by_lang = {r["lang"]: np.array(r["v"], np.float64) for r in found}
    return {k: _unit(v) for k, v in sorted(by_lang.items()) if v.any()}


def identify(df: DataFrame, training: DataFrame, text_col: str = "text", lang_col: str = "lang", keep: dict[str, Column] | None = None,
             max_languages: int = 1000) -> DataFrame:
    """Per row of ``df``: the columns ``keep``, ``lang_pred`` and ``score``.

    The score is the nearest prototype's cosine, moved from -1..1 to 0..1. NULL texts and texts without a letter get ``und`` and 0, as do
    all texts if nothing could be learnt. Ties go to the language that sorts first. Only ``text_col`` is read for a prediction, whole, however long; repeated rows are
    scored, and learnt from, each. Other columns do not matter, but ``keep`` may not name one ``__text``. An empty ``df`` gives an empty result.
    """
    learnt = prototypes(training, text_col, lang_col, max_languages)
    langs = list(learnt)
    base = np.stack([learnt[k] for k in langs]) if langs else np.zeros((0, DIMENSIONS))
    centre = base.mean(axis=0) if len(langs) > 1 else np.zeros(DIMENSIONS)
    compare = _unit(base - centre)
    keep = keep or {}
    names = list(keep)
    batch_rows(df.sparkSession, 500)
    chosen = df.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).cast("string").alias("__text"))
    schema = chosen.drop("__text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "__text"):
            vectors = bundles([t or b"" for t in texts]).astype(np.float64)
            known = vectors.any(axis=1) & bool(langs)
            found, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if known.any():
                cosines = _unit(_unit(vectors[known]) - centre) @ compare.T
                found[known] = np.array(langs, object)[cosines.argmax(axis=1)]
                scores[known] = np.clip((1 + cosines.max(axis=1)) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in names] + [pa.array(found.tolist(), pa.string()), pa.array(scores)],
                                             names=[*names, "lang_pred", "score"])

    return chosen.mapInArrow(run, schema)
