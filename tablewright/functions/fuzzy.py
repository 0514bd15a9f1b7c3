"""Repair of misspelt categories against a list of golden values.

Two scorers give a similarity of 0..100:

``weighted``  the weighted ratio known from Python's fuzzy matching tools: plain, token-sorted,
              token-set and (for texts of very different length) partial matching. It also recognises
              abbreviations and reordered words. It has no JVM expression, so it runs in an Arrow
              batch, over the distinct values of a table that are not golden.
``edit``      100 * (1 - levenshtein / (len a + len b)), a plain column expression.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.session import materialise

SCORERS = ("weighted", "edit")


def edit_score(c: Column, golden: str) -> Column:
    distance = F.levenshtein(c, F.lit(golden))
    return F.round(100.0 * (1.0 - distance / (F.length(c) + len(golden))))


def _alike(a: str, b: str) -> int:
    """Share of matching characters in percent."""
    return round(100 * SequenceMatcher(None, a, b).ratio()) if a and b else 0


def _inside(a: str, b: str) -> int:
    """The shorter text against the best stretch of its length in the longer one."""
    if len(a) > len(b):
        a, b = b, a
    if not a or a in b:
        return 100 if a else 0
    return max(_alike(a, b[i:i + len(a)]) for i in range(len(b) - len(a) + 1))


def _by_words(a: str, b: str, score) -> int:
    """Best of: words in order of the alphabet; shared words against each side; one side against the other, shared words first."""
    x, y = a.split(), b.split()
    shared = sorted(set(x) & set(y))
    x_first, y_first = (" ".join(shared + sorted(set(side) - set(shared))) for side in (x, y))
    joined = " ".join(shared)
    return max(score(" ".join(sorted(x)), " ".join(sorted(y))), score(joined, x_first), score(joined, y_first), score(x_first, y_first))


# A comparison by words weighs 0.95. From a length ratio of 1.5 on, stretches are compared and weigh 0.9, above a ratio
# of 8 they weigh 0.6.
WORDS_WEIGHT, STRETCH_FROM, STRETCH_WEIGHT, FAR_FROM, FAR_WEIGHT = 0.95, 1.5, 0.9, 8, 0.6


@lru_cache(maxsize=65536)
def weighted_score(a: str, b: str) -> int:
    """Weighted similarity of two texts, 0..100; case and punctuation do not count."""
    a, b = (" ".join(re.sub(r"\W", " ", t).lower().split()) for t in (a, b))
    if not a or not b:
        return 0
    ratio = max(len(a), len(b)) / min(len(a), len(b))
    scores = [_alike(a, b)]
    if ratio < STRETCH_FROM:
        scores.append(WORDS_WEIGHT * _by_words(a, b, _alike))
    else:
        weight = FAR_WEIGHT if ratio > FAR_FROM else STRETCH_WEIGHT
        scores += [weight * _inside(a, b), weight * WORDS_WEIGHT * _by_words(a, b, _inside)]
    return round(max(scores))


def _weighted_match(c: Column, golden: Sequence[str], threshold: float) -> Column:
    golden = list(golden)

    def best(value: str) -> str | None:
        scores = [weighted_score(value, g) for g in golden]
        top = max(scores)
        return golden[scores.index(top)] if top >= threshold else None

    @F.pandas_udf("string")
    def match(values: pd.Series) -> pd.Series:
        known = {v: best(v) for v in values.dropna().unique()}
        return pd.Series([known.get(v) for v in values], dtype=object)

    return match(c)


def _edit_match(c: Column, golden: Sequence[str], threshold: float) -> Column:
    ranked = F.array_max(F.array(*[
        F.struct(edit_score(c, g).alias("score"), F.lit(-i).alias("rank"), F.lit(g).alias("value"))
        for i, g in enumerate(golden)]))
    return F.when(ranked["score"] >= threshold, ranked["value"])


def canonicalise(c: Column, golden: Sequence[str], threshold: float = 90, scorer: str = "weighted") -> Column:
    """Golden values stay; others become the best golden value at or above the threshold, else NULL.

    Ties go to the value listed first. No join and no shuffle: each row is decided on its own, which also suits a stream.
    ``canonicalise_columns`` scores each distinct value of a table once.
    """
    if scorer not in SCORERS:
        raise ValueError(f"unknown fuzzy scorer: {scorer!r}")
    golden = list(golden)
    unknown = F.when(~c.isin(golden), c)
    match = _edit_match if scorer == "edit" else _weighted_match
    return F.when(c.isin(golden), c).otherwise(match(unknown, golden, threshold))


LITERAL_VALUES = 1000
BROADCAST_VALUES = 20_000


def canonicalise_columns(df: DataFrame, specs: Mapping[str, Sequence[str]], threshold: float = 90, scorer: str = "weighted",
                         source: DataFrame | None = None) -> DataFrame:
    """``canonicalise`` for columns of a batch table, each distinct value scored once.

    The values that are neither golden nor missing are collected by a distinct aggregate over all columns; only those are scored,
    and only those that are repaired are brought back: up to ``LITERAL_VALUES`` of them as sets of texts per golden value in one projection, up to
    ``BROADCAST_VALUES`` by broadcast. Beyond that, the rows that need a repair are joined by value, column by column, and the others pass by. ``source`` may name a table with at least the values of
    ``df`` that is cheaper to read.
    """
    if scorer not in SCORERS:
        raise ValueError(f"unknown fuzzy scorer: {scorer!r}")
    if scorer == "edit" or df.isStreaming or not specs:
        return df.select(*[canonicalise(F.col(f"`{c}`"), specs[c], threshold, scorer).alias(c) if c in specs else F.col(f"`{c}`")
                           for c in df.columns])
    cells = (df if source is None else source).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.when(~F.col(f"`{c}`").isin(list(golden)), F.col(f"`{c}`")).alias("value"))
        for i, (c, golden) in enumerate(specs.items())])))
    unknown = cells.where("value IS NOT NULL").distinct()
    lists = [list(golden) for golden in specs.values()]

    @F.pandas_udf("string")
    def best(column: pd.Series, values: pd.Series) -> pd.Series:
        out = []
        for i, value in zip(column, values):
            scores = [weighted_score(value, g) for g in lists[i]]
            top = max(scores, default=-1)
            out.append(lists[i][scores.index(top)] if top >= threshold else None)
        return pd.Series(out, dtype=object)

    repairs = materialise(unknown.select("i", "value", best("i", "value").alias("fixed")).where("fixed IS NOT NULL"), "repairs")
    few = repairs.limit(LITERAL_VALUES + 1).collect()
    if len(few) <= LITERAL_VALUES:
        texts: dict = {}
        for r in few:
            texts.setdefault((r["i"], r["fixed"]), []).append(r["value"])

        def repaired_by_sets(i: int, c: str) -> Column:
            cell = F.col(f"`{c}`")
            golden = [g for g in specs[c] if (i, g) in texts]
            out = F.when(cell.isin(list(specs[c])), cell)
            for g in dict.fromkeys(golden):
                out = out.when(cell.isin(texts[i, g]), F.lit(g))
            return out.alias(c)

        place = {c: i for i, c in enumerate(specs)}
        return df.select(*[repaired_by_sets(place[c], c) if c in place else F.col(f"`{c}`") for c in df.columns])
    small = repairs.count() <= BROADCAST_VALUES
    for i, (c, golden) in enumerate(specs.items()):
        found = repairs.where(F.col("i") == i).select(F.col("value").alias("__value"), F.col("fixed").alias("__fixed"))
        known = F.coalesce(F.col(f"`{c}`").isin(list(golden)), F.lit(True))
        repaired = F.when(known, F.col(f"`{c}`")).otherwise(F.col("__fixed")).alias(c)
        chosen = [repaired if x == c else F.col(f"`{x}`") for x in df.columns]
        if small:
            df = df.join(F.broadcast(found), F.col(f"`{c}`") == F.col("__value"), "left").select(*chosen)
        else:
            odd = df.where(~known).join(found, F.col(f"`{c}`") == F.col("__value"), "left").select(*chosen)
            df = df.where(known).unionByName(odd)
    return df
