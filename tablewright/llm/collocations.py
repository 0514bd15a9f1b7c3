"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: at each word the word itself and the three that follow it in its piece, padded with NULL where the piece ends. A phrase
of k words starts one such window per occurrence, so Spark's ROLLUP over the four lead columns yields the counts of all shorter phrases, of the
words, and of the words of a language, from one set of counts.

A window is padded, too, before the first two words in a row that occur together less often than ``min_count``: no candidate reaches across them, so no count of
``min_count`` or more changes. Which pairs these are, a bitmap tells: pairs are counted by a 64-bit hash, and the frequent ones set a bit each.
Pairs that share a hash or a bit with a frequent one are counted in vain, no more. The bitmap has 16 bits a frequent pair, up to ``BITMAP_BITS`` (16 MB);
beyond that it lets more pass, and the windows take more room, up to all of them at full length.

Windows are counted per task before they are shuffled by all their words, so a hot word, pair or phrase is a row a task. Candidates are cut by
equi-joins with the counts, and phrases inside longer ones drop by a combinable maximum.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.common import arrow_batches, text_batches
from tablewright.session import materialise, release

# What ends a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
MARK = b"\xff"  # in no UTF-8 text
TO_MARK = bytes.maketrans(PIECE_ENDS, MARK * len(PIECE_ENDS))
SLICE = 1 << 22
CHUNK = 1 << 20  # words whose windows are counted at once
BITMAP_BITS = 1 << 27
WIDTH = 4
LEAD = ["w1", "w2", "w3", "w4"]


def slices(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text with ``MARK`` between pieces, slice by slice; a slice ends where a piece ends, if one does within it."""
    text = (text or b"").lower().translate(TO_MARK)
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= SLICE else text.rfind(MARK, at, at + SLICE) + 1 or text.find(MARK, at) + 1 or len(text)
        yield text[at:end].replace(MARK, b" \xff ").split()
        at = end


def _numbers() -> defaultdict:
    numbers = defaultdict(count(1).__next__)
    numbers[MARK] = 0
    return numbers


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """(language, numbers with 0 between pieces and documents, words from number 1 on) of about ``CHUNK`` words or fewer."""
    held = {}
    for batch, texts in text_batches(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            if lang not in held:
                held[lang] = [_numbers(), [], 0]
            for some in slices(text):
                state = held[lang]
                state[1] += [np.fromiter(map(state[0].__getitem__, some), np.int32, len(some)), np.zeros(1, np.int32)]
                state[2] += len(some) + 1
                if state[2] >= CHUNK:
                    yield lang, np.concatenate(state[1]), list(state[0])[1:]
                    held[lang] = [_numbers(), [], 0]
        if sum(s[2] for s in held.values()) >= 2 * CHUNK or len(held) > 64:
            for lang, (words, parts, _) in held.items():
                yield lang, np.concatenate([*parts, np.zeros(1, np.int32)]), list(words)[1:]
            held = {}
    for lang, (words, parts, _) in held.items():
        yield lang, np.concatenate([*parts, np.zeros(1, np.int32)]), list(words)[1:]


def _texts(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))


def _pair_hashes(lang: str, words: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of word numbers (from 1)."""
    seed = xxhash.xxh32_intdigest(lang.encode())
    h = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    x = h[left - 1] * np.uint64(0x9E3779B97F4A7C15) + h[right - 1]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def pair_counts(texts: DataFrame) -> DataFrame:
    """``hash`` and ``n`` of the pairs of words that stand in a row in a piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, numbers, words in _chunks(batches):
            both = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
            pairs, n = np.unique(numbers[both].astype(np.int64) << 32 | numbers[both + 1], return_counts=True)
            hashes = _pair_hashes(lang, words, pairs >> 32, pairs & 0xFFFFFFFF)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], names=["hash", "n"])

    return texts.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def pair_bitmap(pairs: DataFrame) -> bytes:
    """A bit per hash. Rows of 64 bits reach the driver, ``BITMAP_BITS / 64`` at most."""
    size = min(BITMAP_BITS, max(1 << 16, 1 << (16 * pairs.count()).bit_length()))
    place = F.col("hash").bitwiseAND(F.lit(size - 1))
    rows = pairs.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 63 as int))")).alias("bits")).toPandas()
    bits = np.zeros(size // 64, "<i8")
    bits[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return bits.tobytes()


def window_counts(texts: DataFrame, bitmap: bytes) -> DataFrame:
    """``lang``, ``w1`` to ``w4``, ``n``: the longest windows, counted chunk by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap, np.uint8)
        for lang, numbers, words in _chunks(batches):
            if not words:
                continue
            both = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
            at = _pair_hashes(lang, words, numbers[both], numbers[both + 1]) & np.uint64(len(bits) * 8 - 1)
            goes_on = np.zeros(len(numbers) + WIDTH, bool)
            goes_on[both] = bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1
            start = np.flatnonzero(numbers)
            rows = np.zeros((len(start), WIDTH), np.int64)
            rows[:, 0] = numbers[start]
            open_ = np.arange(len(start))
            for k in range(1, WIDTH):
                open_ = open_[goes_on[start[open_] + k - 1]]
                rows[open_, k] = numbers[start[open_] + k]
            left, right = rows[:, 0] << 32 | rows[:, 1], rows[:, 2] << 32 | rows[:, 3]
            order = np.lexsort((right, left))
            left, right = left[order], right[order]
            first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
            n = np.diff(np.append(first, len(left)))
            columns = [left[first] >> 32, left[first] & 0xFFFFFFFF, right[first] >> 32, right[first] & 0xFFFFFFFF]
            names = pa.array([None, *words], pa.binary()).cast(pa.string())
            for i in range(0, len(first), 100_000):
                some = [names.take(pa.array(c[i:i + 100_000])) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some[0])), *some, pa.array(n[i:i + 100_000])], names=["lang", *LEAD, "n"])

    return texts.mapInArrow(run, "lang string, w1 string, w2 string, w3 string, w4 string, n long")


def phrase_counts(df: DataFrame, min_count: int = 30, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``words`` (an array of 1 to 4), ``f``: all phrases that occur ``min_count`` times or more; with no words, ``f`` is the words of the language.

    Texts are taken whole; NULL and blank ones have no words, a NULL language is ``und``. Overlapping occurrences count; repeated rows count each. An empty table has no rows.
    """
    texts = _texts(df, text_col, lang_col)
    with arrow_batches(df.sparkSession, 1000):
        pairs = materialise(pair_counts(texts).where(F.col("n") >= min_count), "pairs")
        bitmap = pair_bitmap(pairs)
        release(pairs)
        counted = materialise(window_counts(texts, bitmap).groupBy("lang", *LEAD).agg(F.sum("n").alias("n")), "windows")
    level = WIDTH - F.bit_count(F.grouping_id())
    rolled = counted.rollup("lang", *LEAD).agg(F.sum("n").alias("f"), level.alias("k"), F.grouping_id().alias("gid"))
    own = F.array(*LEAD)
    last = F.when(F.col("k") > 0, F.get(own, F.col("k") - 1).isNotNull() & (F.col("f") >= min_count)).otherwise(F.lit(True))
    return rolled.where((F.col("gid") < 1 << WIDTH) & last).select("lang", F.slice(own, F.lit(1), F.col("k").cast("int")).alias("words"), "f")


def collocations(df: DataFrame, min_count: int = 30, top: int = 2000, covered: int = 80, scale: int = 2_000_000,
                 text_col: str = "text", lang_col: str = "lang", parts: int | None = None) -> DataFrame:
    """The ``top`` phrases of 2 to 4 words of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A phrase scores ``floor(scale * a / (l + r))`` at the cut into two parts where that is least, at the earliest such cut; ``a``, ``l``, ``r`` count the phrase and its parts, ``n`` the
    words of the language. A phrase drops if a longer one around it occurs ``covered`` percent as often or more. Ties of score go by ``a``, then by the phrase's UTF-8 bytes.
    Products are decimals of 38 digits, quotients whole. NULLs, empty texts, repeats and empty tables: see ``phrase_counts``.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialise(phrase_counts(df, min_count, text_col, lang_col).select(
        "lang", "words", F.array_join("words", " ").alias("phrase"), F.col("f").cast("long").alias("f")), "phrases")
    size = F.size("words")
    longer = counts.where(size >= 2).select("lang", "words", "phrase", F.col("f").alias("a"))
    parts_of = counts.where(size.between(1, WIDTH - 1)).select("lang", "phrase", "f")
    cuts = longer.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.lit(WIDTH)), " ").alias("right"))
    scored = (cuts.join(parts_of.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"])
              .join(parts_of.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"])
              .withColumn("score", F.expr(f"cast({scale} as decimal(18,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    inner = longer.where(size >= 3).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("k")).select(
        "lang", "a", "words", "k", F.explode(F.sequence(F.lit(1), size - F.col("k") + 1)).alias("at")).select(
        "lang", "a", F.array_join(F.slice("words", F.col("at"), F.col("k")), " ").alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    wide = [F.col(c).cast("decimal(19,0)") for c in ("around", "a")]
    kept = best.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (wide[0] * 100 < wide[1] * covered)).select(
        "lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language is ranked in shares first, so that no task sorts all its phrases.
    share = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = kept.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    total = counts.where(size == 0).select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
