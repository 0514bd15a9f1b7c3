"""Hold-out and k-fold splits of exact size.

A row's place in the shuffle is the md5 of its key and the seed. "The first k rows of the shuffle" is then
"digest <= the k-th smallest digest", so a split needs only a few threshold digests, per class if
stratified. These come from histograms of the digests: each pass counts the rows of 1024 slices (combined
map-side) and descends into the slice that holds the wanted rank, until a handful of rows is left. The split
itself is a comparison per row: no sort, no window, no shuffle of rows, whatever the size of a class.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.hashing import HASH_BITS, digest_prefix, shuffle_digest
from tablewright.operators.columns import q, require
from tablewright.operators.ordered import row_numbers
from tablewright.session import materialise, release

SLICE_BITS = 10
LEAF_ROWS = 64
# Up to so many classes their histograms and thresholds pass through the driver; beyond it they stay tables.
DRIVER_CLASSES = 64


def _class_slices(rows: DataFrame) -> DataFrame:
    """First histogram: rows per class and top slice."""
    shift = HASH_BITS - SLICE_BITS
    return rows.groupBy("class", F.shiftright("h", shift).alias("slice")).agg(F.count(F.lit(1)).alias("n"))


def _thresholds(rows: DataFrame, ranks_of, class_type: T.DataType) -> dict:
    """{class: [digest at each wanted rank]}; ``ranks_of`` maps {class: n} to {class: [0-based ranks]}."""
    first = _class_slices(rows).collect()
    classes = sorted({r["class"] for r in first}, key=lambda v: (v is None, v if v is not None else 0))
    histogram: dict = {}
    for r in first:
        histogram.setdefault((r["class"], 0), {})[r["slice"]] = r["n"]
    ranks = ranks_of({c: sum(histogram[(c, 0)].values()) for c in classes})

    # An open search is (class, rank wanted within the span, first digest prefix of the span).
    out = {c: [None] * len(ranks[c]) for c in classes}
    open_searches = [(c, i, rank, 0) for c in classes for i, rank in enumerate(ranks[c])]
    leaves = []
    shift = HASH_BITS - SLICE_BITS
    while open_searches:
        deeper = []
        for c, i, rank, start in open_searches:
            for piece, n in sorted(histogram[(c, start)].items()):
                if rank < n:
                    break
                rank -= n
            begin = start + (piece << shift)
            (leaves if n <= LEAF_ROWS else deeper).append((c, i, rank, begin, shift))
        if deeper and shift == 0:
            raise ValueError("the split key repeats: it must be unique per row")
        open_searches = [(c, i, rank, begin) for c, i, rank, begin, _ in deeper]
        if open_searches:
            spans = sorted({(c, begin) for c, _, _, begin in open_searches}, key=str)
            inside = _in_spans(rows, [(c, b, b + (1 << shift) - 1) for c, b in spans], class_type)
            shift = max(0, shift - SLICE_BITS)
            counted = (inside.groupBy("class", "begin", F.shiftright(F.col("h") - F.col("begin"), shift).alias("slice"))
                       .agg(F.count(F.lit(1)).alias("n")).collect())
            histogram = {}
            for r in counted:
                histogram.setdefault((r["class"], r["begin"]), {})[r["slice"]] = r["n"]
    if leaves:
        spans = sorted({(c, begin, begin + (1 << width) - 1) for c, _, _, begin, width in leaves}, key=str)
        # At most LEAF_ROWS rows per wanted rank.
        few = _in_spans(rows, spans, class_type).select("class", "begin", "digest").collect()
        digests: dict = {}
        for r in few:
            digests.setdefault((r["class"], r["begin"]), []).append(r["digest"])
        for c, i, rank, begin, _ in leaves:
            ordered = sorted(digests[(c, begin)])
            if rank + 1 < len(ordered) and ordered[rank] == ordered[rank + 1]:
                raise ValueError("the split key repeats: it must be unique per row")
            out[c][i] = ordered[rank]
    return out


def _many_classes(rows: DataFrame) -> bool:
    return rows.select("class").distinct().limit(DRIVER_CLASSES + 1).count() > DRIVER_CLASSES


def _cuts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, cuts): the digests at the wanted ranks of each class, for any number of classes.

    ``wanted`` has (class, ranks). The histograms and searches are tables joined by class; a class is never gathered: a pass
    keeps at most 1024 counts per search, and the last one at most LEAF_ROWS digests.
    """
    state = wanted.select("class", F.posexplode("ranks").alias("i", "rank")).withColumn("prefix", F.lit(0).cast("long"))
    state = materialise(state, "ranks")
    shift = HASH_BITS
    while True:
        shift -= SLICE_BITS
        spans = state.select(F.col("class").alias("span_class"), "prefix").distinct()
        hit = F.col("class").eqNullSafe(F.col("span_class")) & (F.shiftright("h", shift + SLICE_BITS) == F.col("prefix"))
        slices = rows.join(spans, hit).groupBy("span_class", "prefix", F.shiftright("h", shift).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
        listed = slices.groupBy("span_class", "prefix").agg(F.sort_array(F.collect_list(F.struct("slice", "n"))).alias("slices"))
        start = F.struct(F.lit(None).cast("long").alias("slice"), F.col("rank").alias("rank"), F.lit(0).cast("long").alias("n"))
        walk = F.aggregate("slices", start, lambda at, s: F.when(at["slice"].isNotNull(), at).when(
            at["rank"] < s["n"], F.struct(s["slice"].alias("slice"), at["rank"].alias("rank"), s["n"].alias("n"))).otherwise(
            F.struct(F.lit(None).cast("long").alias("slice"), (at["rank"] - s["n"]).alias("rank"), F.lit(0).cast("long").alias("n"))))
        same = F.col("class").eqNullSafe(F.col("span_class")) & (F.col("s.prefix") == F.col("l.prefix"))
        found = materialise(state.alias("s").join(listed.alias("l"), same).select("class", "i", walk.alias("w"))
                            .select("class", "i", F.col("w.rank").alias("rank"), F.col("w.slice").alias("prefix"), F.col("w.n").alias("n")), "ranks")
        release(state)
        state = found
        if shift == 0 or (state.agg(F.max("n")).first()[0] or 0) <= LEAF_ROWS:
            break
    searches = state.select(F.col("class").alias("span_class"), "i", "rank", "prefix")
    hit = F.col("class").eqNullSafe(F.col("span_class")) & (F.shiftright("h", shift) == F.col("prefix"))
    few = rows.join(searches, hit).groupBy("span_class", "i", "rank").agg(F.sort_array(F.collect_list("digest")).alias("digests"))
    at = few.select("span_class", "i", F.get("digests", F.col("rank").cast("int")).alias("cut"),
                    (F.get("digests", F.col("rank").cast("int")) == F.get("digests", F.col("rank").cast("int") + 1)).alias("repeats"))
    cuts = materialise(at.groupBy("span_class").agg(F.sort_array(F.collect_list(F.struct("i", "cut"))).alias("cuts"), F.max("repeats").alias("repeats"))
                       .select(F.col("span_class").alias("class"), F.transform("cuts", lambda c: c["cut"]).alias("cuts"), "repeats"), "cuts")
    release(state)
    if cuts.agg(F.max("repeats")).first()[0]:
        raise ValueError("the split key repeats: it must be unique per row")
    return cuts.drop("repeats")


def _attach_cuts(df: DataFrame, strata: str, cuts: DataFrame) -> DataFrame:
    table = cuts.select(F.col("class").alias("__class"), F.col("cuts").alias("__cuts"))
    joined = df.join(table, q(strata).eqNullSafe(F.col("__class")), "left").drop("__class")
    return joined.withColumn("__cuts", F.coalesce("__cuts", F.array().cast("array<string>")))


def _quota_table(rows: DataFrame, test_size: float) -> DataFrame:
    """(class, ranks) of a hold-out, by largest remainder over any number of classes."""
    counts = materialise(rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")), "class-counts")
    n = counts.agg(F.sum("n")).first()[0] or 0
    total = min(n, math.ceil(round(n * test_size, 9)))
    exact = counts.withColumn("exact", F.lit(total) * F.col("n") / F.lit(n)).withColumn("base", F.floor("exact"))
    spare = total - (exact.agg(F.sum("base")).first()[0] or 0)
    turn = row_numbers(exact.withColumn("rest", F.col("exact") - F.col("base")), [F.col("rest").desc(), F.col("class").asc_nulls_last()], "turn")
    quota = F.col("base") + (F.col("turn") < spare).cast("long")
    return turn.withColumn("quota", quota).select("class", F.when(F.col("quota") > 0, F.array(F.col("quota") - 1)).otherwise(
        F.array().cast("array<bigint>")).alias("ranks"))


def _fold_table(rows: DataFrame, n_folds: int) -> DataFrame:
    """(class, ranks) of the last row of each fold but the last non-empty one."""
    counts = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    ends = F.transform(F.sequence(F.lit(1), F.lit(n_folds - 1)), lambda i: F.floor(F.col("n") / n_folds) * i + F.least(i.cast("long"), F.col("n") % n_folds))
    return counts.select("class", F.array_distinct(F.filter(F.transform(F.filter(ends, lambda e: (e > 0) & (e < F.col("n"))), lambda e: e - 1),
                                                            lambda r: r >= 0)).alias("ranks"))


def _in_spans(rows: DataFrame, spans, class_type: T.DataType) -> DataFrame:
    schema = T.StructType([T.StructField("span_class", class_type), T.StructField("begin", T.LongType()),
                           T.StructField("end", T.LongType())])
    # A few spans per class, of which there are at most DRIVER_CLASSES.
    table = F.broadcast(rows.sparkSession.createDataFrame(spans, schema))
    hit = F.col("class").eqNullSafe(F.col("span_class")) & F.col("h").between(F.col("begin"), F.col("end"))
    return rows.join(table, hit)


def _shuffled(df: DataFrame, key: Sequence[str], strata: str | None, seed: int) -> tuple[DataFrame, T.DataType]:
    require(df, key, "split key")
    c = F.lit(0) if strata is None else q(strata)
    rows = df.select(c.alias("class"), shuffle_digest(key, seed).alias("digest"))
    rows = rows.select("class", "digest", digest_prefix(F.col("digest")).alias("h"))
    return rows, rows.schema["class"].dataType


def _attach(df: DataFrame, strata: str | None, class_type, thresholds: dict) -> DataFrame:
    """Add the array column ``__cuts`` of the row's class."""
    if strata is None:
        cuts = next(iter(thresholds.values()), [])
        return df.withColumn("__cuts", F.array(*[F.lit(d) for d in cuts]).cast("array<string>"))
    schema = T.StructType([T.StructField("__class", class_type), T.StructField("__cuts", T.ArrayType(T.StringType()))])
    # One row per class, at most DRIVER_CLASSES.
    table = F.broadcast(df.sparkSession.createDataFrame(list(thresholds.items()), schema))
    return df.join(table, q(strata).eqNullSafe(F.col("__class"))).drop("__class")


def _quotas(counts: dict, test_size: float) -> dict:
    """Test rows per class: ceil(n * test_size) in all, shared out by largest remainder."""
    n = sum(counts.values())
    # Rounded first, so that 0.2 * 15 does not become 4 rows through a last binary digit.
    total = min(n, math.ceil(round(n * test_size, 9)))
    exact = {c: total * k / n for c, k in counts.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(counts, key=lambda c: -(exact[c] - quota[c]))
    for c in by_remainder[:total - sum(quota.values())]:
        quota[c] += 1
    return quota


def mark_holdout(df: DataFrame, key: Sequence[str], test_size: float = 0.2, target: str | None = None,
                 seed: int = 42, out: str = "is_test") -> DataFrame:
    """Add a boolean column: is the row in the test part? Stratified if the table has the target."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    strata = target if target in df.columns else None
    rows, class_type = _shuffled(df, key, strata, seed)

    def ranks(counts):
        quota = _quotas(counts, test_size) if counts else {}
        return {c: [quota[c] - 1] if quota[c] else [] for c in counts}

    if strata is not None and _many_classes(rows):
        marked = _attach_cuts(df, strata, _cuts(rows, _quota_table(rows, test_size)))
    else:
        marked = _attach(df, strata, class_type, _thresholds(rows, ranks, class_type))
    digest = shuffle_digest(key, seed)
    is_test = F.coalesce(digest <= F.try_element_at("__cuts", F.lit(1)), F.lit(False))
    return marked.withColumn(out, is_test).drop("__cuts")


def holdout_split(df: DataFrame, key: Sequence[str], test_size: float = 0.2, target: str | None = None,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    marked = mark_holdout(df, key, test_size, target, seed, "__test")
    return marked.filter(~F.col("__test")).drop("__test"), marked.filter("__test").drop("__test")


def mark_folds(df: DataFrame, key: Sequence[str], n_folds: int = 3, stratify_by: str | None = None,
               seed: int = 42, out: str = "fold") -> DataFrame:
    """Add the fold 0..n_folds-1; sizes differ by at most one, within each class if stratified."""
    if n_folds < 2:
        raise ValueError("n_folds must be at least 2")
    rows, class_type = _shuffled(df, key, stratify_by, seed)

    def ranks(counts):
        ends = {}
        for c, n in counts.items():
            sizes = [n // n_folds + (i < n % n_folds) for i in range(n_folds)]
            ends[c] = [sum(sizes[:i + 1]) - 1 for i in range(n_folds - 1) if sizes[i] and sum(sizes[:i + 1]) < n]
        return ends

    if stratify_by is not None and _many_classes(rows):
        marked = _attach_cuts(df, stratify_by, _cuts(rows, _fold_table(rows, n_folds)))
    else:
        marked = _attach(df, stratify_by, class_type, _thresholds(rows, ranks, class_type))
    digest = shuffle_digest(key, seed)
    return marked.withColumn(out, F.size(F.filter("__cuts", lambda cut: cut < digest))).drop("__cuts")
