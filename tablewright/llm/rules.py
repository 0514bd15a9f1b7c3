"""Quality rules: a decision list learnt from labelled statistics by sequential covering.

Statistics of each text are column expressions. The learner grows one rule at a time for the low-quality class: a
conjunction of thresholds, each added for its information gain on the growing part of the labelled rows, then cut back to
the prefix that does best on the pruning part. Rows that an accepted rule covers leave both parts, and the next rule is grown on
the rest. The list is emitted as one ordered conditional expression, which Spark evaluates inside its scan stage.

The learner sees the rows only through counts per (statistic, threshold): a few hundred numbers per step. The labelled
rows are a bounded sample (``max_rows``), chosen by a hash of the id. All of it is DataFrame expressions and aggregates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import fold_key, let, sampled, words
from tablewright.session import materialise, release

SYMBOLS = "#*$%&|<>"
FEW = 64  # repeated windows that are looked up one by one
STATISTICS = ("n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "capital_share",
              "mark_share")


def _repeat_words(tokens: Column) -> Column:
    """Words that lie in a 3-word window found at least twice.

    The hashed windows are sorted, and equal neighbours are the repeated ones. The places of repeated windows, in order,
    cover ``min(3, distance to the next place)`` words each. Few repeated windows are looked up in a list, many are
    sorted together with their places: n log n in the words of the row at worst.
    """
    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(places, lambda p, i: F.coalesce(F.least(F.get(places, i + 1) - p, F.lit(3)), F.lit(3))),
            F.lit(0).cast("long"), lambda acc, n: acc + n)

    def sorted_places(hashes: Column) -> Column:
        def repeated(pairs: Column) -> Column:
            return F.sort_array(F.transform(
                F.filter(pairs, lambda w, i: (F.get(pairs, i - 1)["h"] == w["h"]) | (F.get(pairs, i + 1)["h"] == w["h"])),
                lambda w: w["p"]))

        return let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), repeated)

    def places(hashes: Column, twice: Column) -> Column:
        few = F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains(twice, F.get(hashes, i)))
        return F.when(F.size(twice) <= FEW, few).otherwise(sorted_places(hashes))

    def count(hashes: Column) -> Column:
        twice = let(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(s, lambda h, i: F.get(s, i - 1) == h)))
        return let(twice, lambda t: F.when(F.size(t) == 0, F.lit(0).cast("long")).otherwise(let(places(hashes, t), covered)))

    windows = F.transform(F.sequence(F.lit(0), F.size(tokens) - 3),
                          lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))
    return F.when(F.size(tokens) > 3, let(windows, count)).otherwise(F.lit(0).cast("long"))


def _found(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in the class ``chars``."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def base_statistics(text: Column) -> dict[str, Column]:
    """Counts over the whole text; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    of_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
        _repeat_words(w).alias("repeat")))
    of_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
    return {"of_words": of_words, "of_lines": of_lines, "n_symbols": _found(text, SYMBOLS), "n_capitals": _found(text, "A-Z"),
            "n_marks": _found(text, "!?")}


def with_statistics(df: DataFrame, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """``keep`` and the base counts, then the ratios that the rules test. A ratio over no words is 0."""
    found = df.select(*[c.alias(k) for k, c in keep.items()], *[c.alias(k) for k, c in base_statistics(F.col(text_col)).items()])
    counted = found.select(*keep, F.col("of_words.n").alias("n_words"), F.col("of_words.chars").alias("word_chars"), "n_symbols",
                           F.col("of_lines.n").alias("n_lines"), F.col("of_lines.dup").alias("n_dup_lines"),
                           F.col("of_words.repeat").alias("n_repeat_words"), "n_capitals", "n_marks")

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return counted.withColumns({
        "mean_word_chars": ratio("word_chars", "n_words"), "symbols_per_word": ratio("n_symbols", "n_words"),
        "dup_line_share": ratio("n_dup_lines", "n_lines"), "repeat_share": ratio("n_repeat_words", "n_words"),
        "capital_share": ratio("n_capitals", "word_chars"), "mark_share": ratio("n_marks", "n_words")})


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class Rule:
    conditions: list[Condition]
    precision: float = 0.0

    def column(self) -> Column:
        result = F.lit(True)
        for c in self.conditions:
            result = result & c.column()
        return result

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    """Rules in order; the first that holds rejects a text, and a text that none holds for is kept."""

    rules: list[Rule] = field(default_factory=list)

    def kept(self) -> Column:
        verdict = F.lit(True)
        for rule in reversed(self.rules):
            verdict = F.when(rule.column(), F.lit(False)).otherwise(verdict)
        return verdict


def _thresholds(rows: DataFrame, steps: int) -> dict[str, list[float]]:
    """Candidate thresholds per statistic: ``steps`` quantiles of each class."""
    shares = [i / (steps + 1) for i in range(1, steps + 1)]
    found = rows.groupBy("bad").agg(*[F.percentile_approx(s, shares, 2000).alias(s) for s in STATISTICS]).collect()
    return {s: sorted({float(x) for r in found for x in r[s] or ()}) for s in STATISTICS}


def _binned(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Add ``<statistic>_bin``: the number of cuts below the value."""
    def bin_of(s: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[s]]), lambda c: c < F.col(s))) if cuts[s] else F.lit(0)

    return rows.withColumns({f"{s}_bin": bin_of(s) for s in STATISTICS})


def _best_condition(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition | None, float]:
    """The condition of the highest information gain over ``rows``, and the share of bad rows that it reaches."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"{s}_bin").alias("b")) for s in STATISTICS])).alias("at")
    counts = rows.select("bad", pairs).groupBy("at.s", "at.b").agg(
        F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")).collect()
    by: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts:
        by.setdefault(r["s"], {})[r["b"]] = (r["p"], r["n"])
    some = by.get(STATISTICS[0], {})
    p0, n0 = sum(p for p, _ in some.values()), sum(n for _, n in some.values())
    best, best_gain, best_precision = None, 1e-9, 0.0
    if not p0 or not n0:
        return None, float(bool(p0))
    for s in STATISTICS:
        below_p = below_n = 0
        for i, cut in enumerate(cuts[s]):
            p, n = by[s].get(i, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
                if p:
                    gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                    if gain > best_gain:
                        best, best_gain, best_precision = Condition(s, above, cut), gain, p / (p + n)
    return best, best_precision


def _pruned(rows: DataFrame, conditions: list[Condition], min_precision: float) -> Rule | None:
    """The prefix of ``conditions`` with the best (p - n) / (p + n) on ``rows``, if precise enough after Laplace."""
    prefixes = [Rule(conditions[:k]) for k in range(1, len(conditions) + 1)]
    sums = []
    for i, rule in enumerate(prefixes):
        sums += [F.sum((rule.column() & F.col("bad")).cast("long")).alias(f"p{i}"),
                 F.sum((rule.column() & ~F.col("bad")).cast("long")).alias(f"n{i}")]
    got = rows.agg(*sums).first()
    best = None
    for i, rule in enumerate(prefixes):
        p, n = got[f"p{i}"] or 0, got[f"n{i}"] or 0
        rule.precision = (p + 1) / (p + n + 2)
        worth = (p - n) / (p + n) if p + n else -1.0
        if p and rule.precision >= min_precision and (best is None or worth > best[0] + 1e-9):
            best = (worth, rule)
    return best and best[1]


def learn_rules(rows: DataFrame, max_rules: int = 8, max_conditions: int = 4, min_precision: float = 0.9,
                steps: int = 24) -> DecisionList:
    """Learn a list from ``rows``: the statistics, ``bad`` (boolean) and ``fold`` (long; every third row prunes).

    Without bad rows, or without good ones, the list is empty and keeps everything.
    """
    cuts = _thresholds(rows, steps)
    table = materialise(_binned(rows, cuts), "rule-rows")
    grow, prune = table.where("fold % 3 != 0"), table.where("fold % 3 = 0")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        free = F.lit(True)
        for rule in rules:
            free = free & ~rule.column()
        conditions: list[Condition] = []
        inside = grow.where(free)
        while len(conditions) < max_conditions:
            condition, precision = _best_condition(inside, cuts)
            if condition is None:
                break
            conditions.append(condition)
            inside = inside.where(condition.column())
            if precision == 1.0:
                break
        rule = _pruned(prune.where(free), conditions, min_precision) if conditions else None
        if rule is None:
            break
        rules.append(rule)
    release(table)
    return DecisionList(rules)


def labelled_statistics(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                        max_rows: int) -> DataFrame:
    """Statistics, ``bad`` and ``fold`` of a sample of about ``max_rows`` labelled documents at most, chosen by a hash of the id."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    total = known.count()
    if total > max_rows:
        known = known.where(sampled(F.col("id"), max_rows, total))
    joined = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id")
    return with_statistics(joined, "text", {"bad": F.col("label") == 0, "fold": fold_key(F.col("id"))})


def apply_rules(df: DataFrame, rules: DecisionList, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50,
                max_repeat_percent: int = 50) -> DataFrame:
    """Per row of ``df``: its id, the base counts, ``base_failed`` and ``kept``; other columns of ``df`` do not matter.

    A NULL or empty text has no words and fails the base test; a NULL id stays NULL; repeated rows are judged each, equal texts alike. Texts are taken whole, however
    long. An empty ``df`` gives an empty result.
    """
    counted = with_statistics(df, text_col, {id_col: F.col(id_col)})
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & rules.kept())


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_rows: int = 20_000, **learning) -> DataFrame:
    """Learn a list from the labelled rows of ``docs`` (label 0: low quality) and apply it to all of them.

    ``max_rows`` bounds the labelled sample. Repeated ids and labels count as often as they occur; labels without a
    document and NULL labels are left out. No labelled row at all gives an empty list.
    """
    rows = materialise(labelled_statistics(docs, labels, id_col, text_col, label_col, max_rows), "rule-stats")
    rules = learn_rules(rows, **learning)
    release(rows)
    return apply_rules(docs, rules, id_col, text_col)
