"""Mixing sources to target weights by entropy balancing.

Targets: the sources, ranked by code point with NULL last, weigh 5, 2, 1, 5, ... and share the tokens of the corpus.
No target may exceed ``cap`` times the tokens its source has; what is cut off is shared again by weight.

Rates: among all ways to reach the targets, entropy balancing takes the one nearest to the corpus, in relative entropy
over tokens. Its convex dual is, with one multiplier per source,

    minimise  sum over documents of size * exp(lambda[source])  -  sum over sources of target * lambda

and its solution tilts each document's rate exponentially: ``exp(lambda[source])``. Gradient and curvature depend on the
documents through the tokens of each source, so one distributed aggregate feeds every Newton step, and the
steps of all sources run side by side as an expression over the table of sources.

Copies: each document gets the whole part of its rate. The rest of a target is reached by documents in the order of a
hash: those below a threshold get one copy more (or, for large parts, those above it). The threshold comes from histograms of the hash weighted by size, refined
around the point where the missing tokens are reached, so no group of rows is ever sorted or gathered; a source with a
third of all rows is many bins. A threshold stops at the first document that does not fit; the gap is closed by the documents behind it
that do, the largest one or, where many are needed, a threshold over them, until none fits.

Everything is DataFrame expressions and aggregates. Documents are written once with their sizes and hashes, so that equal rows keep the order they got, and scanned;
those that close the gaps are joined by their hashes, broadcast while they are few, and the text moves only beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import words
from tablewright.session import materialise, release

BITS = 12  # of the hash, per histogram pass
HASH_BITS = 60
ROW_BITS = 20  # the last bits of the hash, which tell equal rows apart


def source_weights(totals: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Add ``weight``: the weights in turn, over the sources by code point, NULL last.

    Ranks are position within a range partition plus the rows of the partitions before it.
    """
    ordered = materialise(
        totals.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33)
    counts = {r[0]: r[1] for r in ordered.groupBy(part.alias("part")).count().collect()}  # one row per partition
    before, offsets = 0, []
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(before)]
        before += counts[p]
    offset = F.create_map(*offsets)[part] if offsets else F.lit(0)
    rank = offset + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    return ordered.withColumn("weight", F.get(turn, (rank % len(weights)).cast("int"))).drop("place")


def capped_targets(sources: DataFrame, cap: float) -> DataFrame:
    """Add ``target``. Each round shares what the stopped sources leave; a source once stopped stays stopped.

    ``sources`` has ``source``, ``source_size``, ``weight``. The rounds pass a few sums to the driver.
    """
    limit = cap * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:
        stopped = F.lit(share) * F.col("weight") > limit if share else F.lit(False)
        kept, open_weight, n_open = sources.agg(
            F.sum(F.when(stopped, limit)), F.sum(F.when(~stopped, F.col("weight"))), F.sum((~stopped).cast("long"))).first()
        if not n_open:
            return sources.withColumn("target", limit)
        new_share = (total - (kept or 0.0)) / open_weight
        if new_share <= share * (1 + 1e-12):
            return sources.withColumn("target", F.when(stopped, limit).otherwise(F.lit(share) * F.col("weight")))
        share = new_share


def newton_rates(sources: DataFrame, steps: int = 80) -> DataFrame:
    """Add ``rate`` = exp(lambda) from ``steps`` Newton steps on the dual, from lambda = 0.

    The dual is strictly convex and the step is ``lambda - gradient / curvature`` with gradient
    ``size * exp(lambda) - target`` and curvature ``size * exp(lambda)``. After at most one step to the right the steps fall
    to the solution; a step never exceeds one to the left, so targets down to exp(-70) of the size are reached.
    A source without tokens has rate 1.
    """
    wanted = F.col("target") / F.col("source_size")
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0),
                         lambda x, _: x - (F.lit(1.0) - wanted * F.exp(-x)))
    rate = F.when(F.col("source_size") > 0, F.exp(solved)).otherwise(F.lit(1.0))
    near = F.round(rate)
    return sources.withColumn("rate", F.when((near > 0) & (F.abs(rate - near) < 1e-9), near).otherwise(rate))


def _hash(id_col: Column, text: Column) -> Column:
    """Position of a row in the order in which copies are dealt: ``HASH_BITS`` bits, not negative.

    The first bits are a hash of id and text, the last ones of the place of the row in the table: equal rows, which are interchangeable, are dealt one by one (or, of very many,
    a millionth of them at a time).
    """
    content = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), id_col.cast("string"), text), 64 - HASH_BITS + ROW_BITS)
    row = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - ROW_BITS)
    return F.shiftleft(content, ROW_BITS).bitwiseOR(row)


def _threshold(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``below`` and ``reached``: documents with a hash under ``below`` have ``reached`` <= ``missing`` tokens.

    Each pass bins the documents of the open interval of their source by the next ``BITS`` bits and keeps the
    bin in which ``missing`` is crossed. It ends when no such bin holds more than one hash.
    """
    state = sources.withColumn("prefix", F.lit(0).cast("long")).withColumn("reached", F.lit(0).cast("long"))
    state = materialise(state, "mix-state")
    for used in range(BITS, HASH_BITS + 1, BITS):
        rest = HASH_BITS - used
        inside = docs.join(state.select("source_key", "prefix"), "source_key").where(
            F.shiftright("hash", rest + BITS) == F.col("prefix"))
        bins = inside.groupBy("source_key", F.shiftright("hash", rest).alias("bin")).agg(
            F.sum("size").alias("tokens"), F.min("hash").alias("least"), F.max("hash").alias("most"))
        gathered = bins.groupBy("source_key").agg(F.sort_array(F.collect_list(F.struct("bin", "tokens", "least", "most"))).alias("bins"))
        start = F.struct(F.lit(None).cast("long").alias("bin"), F.col("reached").alias("sum"), F.lit(False).alias("open"))
        walk = F.aggregate("bins", start, lambda acc, b: F.when(
            acc["bin"].isNotNull(), acc).when(
            acc["sum"] + b["tokens"] > F.col("missing"),
            F.struct(b["bin"].alias("bin"), acc["sum"].alias("sum"), (b["least"] < b["most"]).alias("open"))).otherwise(
            F.struct(F.lit(None).cast("long").alias("bin"), (acc["sum"] + b["tokens"]).alias("sum"), F.lit(False).alias("open"))))
        end = F.shiftleft(F.col("prefix") + 1, BITS)  # all bins fit: the next free bin
        found = materialise(state.join(gathered, "source_key", "left").select(
            *[c for c in state.columns if c not in ("prefix", "reached", "open")],
            F.when(F.col("bins").isNull(), F.struct(F.shiftleft("prefix", BITS).alias("bin"), F.col("reached").alias("sum"),
                                                   F.lit(False).alias("open"))).otherwise(walk).alias("walk"), end.alias("end"))
            .select("*", F.coalesce("walk.bin", "end").alias("prefix"), F.col("walk.sum").alias("reached"),
                    F.col("walk.open").alias("open")).drop("walk", "end"), "mix-state")
        release(state)
        state = found
        if not state.agg(F.max("open")).first()[0]:
            break
    done = materialise(state.withColumn("below", F.shiftleft("prefix", rest)).drop("prefix", "open"), "mix-state")
    release(state)
    return done


def _close_gaps(docs: DataFrame, dealt: DataFrame) -> DataFrame:
    """``source_key`` and ``hash`` of the documents above the threshold that get a copy too, until none that is left fits the gap.

    In each round a source whose largest fitting document fills more than half of its gap takes that one. Any other takes a
    threshold over the documents that fit, which passes over those that do not; what it leaves is less than one of these documents.
    So a round halves the gap at least, or takes all there is, and the rounds are as many as the gap has bits.
    """
    # Rows that share a hash are taken together, so they have to fit together.
    gaps = dealt.select("source_key", "below", F.floor(F.col("missing") - F.col("reached")).alias("gap"))
    left = materialise(
        docs.join(gaps, "source_key").where((F.col("hash") >= F.col("below")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap")))
        .groupBy("source_key", "hash").agg(F.sum("size").alias("size"), F.first("gap").alias("gap"))
        .where(F.col("size") <= F.col("gap")).withColumn("taken", F.lit(False)), "mix-left")
    steps = [left]
    while steps[-1].agg(F.max(~F.col("taken"))).first()[0]:
        left = steps[-1].where(~F.col("taken")).drop("taken")
        state = materialise(left.groupBy("source_key").agg(
            F.first("gap").alias("missing"), F.max(F.struct("size", "hash")).alias("top")), "mix-state")
        many = F.col("top.size") * 2 <= F.col("missing")
        ends = state.select("source_key", F.when(~many, F.col("top")).alias("top"), F.lit(0).cast("long").alias("below"),
                            (F.col("missing") - F.col("top.size")).alias("rest"))
        found = None
        if state.agg(F.max(many)).first()[0]:
            found = _threshold(left.drop("gap"), state.where(many).drop("top"))
            ends = ends.where("top IS NOT NULL").unionByName(found.select(
                "source_key", F.lit(None).cast(ends.schema["top"].dataType).alias("top"), "below",
                (F.col("missing") - F.col("reached")).alias("rest")))
        taken = F.coalesce(F.col("hash") == F.col("top.hash"), F.col("hash") < F.col("below"))
        steps.append(materialise(left.join(ends, "source_key").select(
            "source_key", "hash", "size", F.col("rest").alias("gap"), taken.alias("taken"))
            .where(F.col("taken") | (F.col("size") <= F.col("gap"))), "mix-left"))
        release(state)
        if found is not None:
            release(found)
    chosen = steps[0].where("taken")
    for step in steps[1:]:
        chosen = chosen.unionByName(step.where("taken"))
    chosen = materialise(chosen.select("source_key", "hash"), "mix-chosen")
    for step in steps:
        release(step)
    return chosen


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, keep: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``df`` with the copies the mix takes of it.

    Returns ``row`` (a struct of the input columns ``keep``, all by default, so that none can clash), ``size`` (words of ``[^\\x20\\x09-\\x0D]+``,
    NULL text: 0), ``source_size``, ``target``, ``rate`` and ``copies`` (0 to ``ceil(cap)``). The same input gives the same result.

    * A NULL source is a source of its own, ranked last. NULL ids and texts are hashed as such.
    * Rows equal in id and text are dealt one by one, and it does not matter which of them. A document without words counts for nothing and is copied by its rate.
    * A source whose documents have no words has target 0 and keeps its documents once.
    * An empty table gives an empty result.

    The table of sources joins the documents by Spark's own choice: broadcast under ``autoBroadcastJoinThreshold``,
    else a sort-merge join whose hot keys adaptive execution splits.
    """
    source = F.col(source_col).cast("string")
    key = F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))  # never NULL, one to one
    keep = df.columns if keep is None else list(keep)
    measured = df.select(key.alias("source_key"), source.alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"),
                         _hash(F.col(id_col), F.col(text_col)).alias("hash"), F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    docs = materialise(measured, "mix-docs")
    totals = docs.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    rated = materialise(newton_rates(capped_targets(source_weights(totals, weights), cap)), "mix-rates")
    # The hash order picks whichever set is smaller, the documents with the extra copy or those without, so that
    # at least about half of the documents are left to close the gap with.
    part = F.col("rate") - F.floor("rate")
    above = F.greatest(F.col("target") - F.floor("rate") * F.col("source_size"), F.lit(0.0))
    needed = rated.withColumn("flip", part > 0.5).select("source_key", "source_size", "target", "rate", "flip", F.when(
        part == 0, 0.0).when(F.col("flip"), F.col("source_size") - above).otherwise(above).alias("missing"))
    small = docs.select("source_key", "size", "hash")
    dealt = _threshold(small, needed)
    chosen = _close_gaps(small, dealt).withColumn("chosen", F.lit(True))
    # Documents without words have no gap to fit: the share of the hashes alone decides.
    share = F.when(F.col("flip"), F.lit(1.0) - part).otherwise(part)
    picked = F.when(F.col("size") == 0, F.col("hash") < share * F.lit(float(1 << HASH_BITS))).otherwise(
        (F.col("hash") < F.col("below")) | F.col("chosen").isNotNull())
    extra = (F.col("rate") != F.floor("rate")) & (picked != F.col("flip"))
    return docs.drop("source").join(dealt, "source_key").join(chosen, ["source_key", "hash"], "left").select(
        "row", "size", "source_size", "target", "rate", (F.floor("rate") + extra.cast("int")).cast("int").alias("copies"))
