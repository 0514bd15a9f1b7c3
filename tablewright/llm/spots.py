"""SpotSigs fingerprints: chains of content words that follow common words.

A common word is an anchor. Its signature is the anchor with the next ``2`` content words (common words between them are passed
over); where several common words stand in a row, the last is the anchor. The fingerprint of a text is the set of its signatures,
written as ascending 32-bit hashes. Two fingerprints are compared by the Jaccard similarity of their sets.

``edited_fingerprints`` compares given pairs. ``similar_classes`` finds all pairs of similarity ``at_least``: such sets lie in the same or in neighbouring
partitions by their length, and share one of their rarest signatures, so these are joined within neighbouring partitions, and what the lengths do not
rule out is compared.

A text in which no common word is followed by two content words has every three words in a row as signatures; with
fewer words, their sequence; without a word, its characters; and the empty text has the empty set.

All of it is column expressions and one shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.common import let
from tablewright.session import materialise

# Common words of English, German, French and Spanish.
COMMON_WORDS = tuple("""
a an and are as at be been but by for from had has have he his if in is it its not of on or she that the their they this to was were which
will with you
aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat ich im ist mit nach nicht noch nur oder
sich sie sind so um und von vor war wie wir wird zu zum zur
au aux avec ce ces dans de du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un
une vous
al como con del el ella ellos era esta este fue ha hay los las lo más me mi no nos para pero por porque ser si sin su sus también una y ya
""".split())

WORD_GAP = r"[^\p{L}\p{N}]+"


def signatures(text: Column) -> Column:
    """Ascending distinct 32-bit signatures of a text, array<int>; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def in_a_row(w: Column) -> Column:
        chains = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.hash(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        few = F.when(F.size(w) > 0, F.array(F.hash(F.array_join(w, " ")))).when(
            F.length(text) > 0, F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))
        return F.when(F.size(w) >= 3, chains).otherwise(few)

    def spots(w: Column, at: Column) -> Column:
        """``at``: places of the content words. A content word is anchored if a common word stands right before it."""
        anchored = F.filter(F.sequence(F.lit(0), F.size(at) - 2),
                            lambda j: (F.get(at, j) > 0) & ((j == 0) | (F.get(at, j) - 1 > F.get(at, j - 1))))
        chains = F.transform(anchored, lambda j: F.hash(F.get(w, F.get(at, j) - 1), F.get(w, F.get(at, j)), F.get(w, F.get(at, j + 1))))
        return F.when(F.size(at) >= 2, chains).otherwise(F.array().cast("array<int>"))

    def of_words(w: Column) -> Column:
        content = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: ~F.get(w, i).isin(*COMMON_WORDS))
        found = F.when(F.size(w) >= 3, let(content, lambda at: spots(w, at))).otherwise(F.array().cast("array<int>"))
        return let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(in_a_row(w)))

    tokens = F.filter(F.split(F.lower(text), WORD_GAP), lambda x: x != "")
    return F.sort_array(F.array_distinct(let(tokens, of_words)))


def fingerprint(signature_set: Column) -> Column:
    """The set as text: 8 hexadecimal digits per signature."""
    return F.lower(F.array_join(F.transform(signature_set, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def length_partition(signature_set: Column, at_least: float) -> Column:
    """Partition k holds set lengths from ``at_least ** -k`` to below the next; the empty set is in partition -1.

    Jaccard similarity is at most the ratio of the lengths, so sets of similarity ``at_least`` are at most one partition apart.
    """
    size = F.size(signature_set)
    return F.when(size > 0, F.floor(F.log(size.cast("double")) / -math.log(at_least) + 1e-9)).otherwise(F.lit(-1)).cast("int")


def likeness(left: Column, right: Column, at_least: float = 0.0) -> Column:
    """Jaccard similarity of two sets, 0 to 1; two empty sets are alike.

    Pruned: if the ratio of the lengths is below ``at_least``, or one set alone is empty, the result is 0 without an intersection.
    """
    a, b = F.size(left), F.size(right)
    common = F.size(F.array_intersect(left, right))
    exact = let(common, lambda n: n / (a + b - n))
    apart = F.least(a, b) < at_least * F.greatest(a, b) - 1e-9
    return F.when((a == 0) & (b == 0), F.lit(1.0)).when((a == 0) | (b == 0) | apart, F.lit(0.0)).otherwise(exact)


def _bounds(df: DataFrame, rows_per_bucket: int, max_buckets: int) -> list[int]:
    """Ids that part the table into about even ranges, the largest id last; each is the id of a row."""
    n, most = df.select(F.count("id"), F.max("id")).first()
    if most is None:
        return []
    buckets = max(1, min(max_buckets, n // rows_per_bucket))
    shares = [i / buckets for i in range(1, buckets)]
    inner = df.select(F.percentile_approx("id", shares, 8 * buckets)).first()[0] if shares else []
    return sorted({*inner, most})


def with_next(df: DataFrame, carried: list[str], rows_per_bucket: int = 64, max_buckets: int = 1 << 16) -> DataFrame:
    """Add ``next_<c>`` for the columns ``carried``: the values of the row that follows by descending ``id``; the first follows the last.

    Ranges of ids are dealt to tasks. The top row of each range also goes to the range above, where it follows the lowest row. NULL ids come
    last; rows of equal id are ordered by the hash of what they carry. ``max_buckets`` bounds the ranges that reach the driver, not the rows.
    """
    bounds = _bounds(df, rows_per_bucket, max_buckets)
    follower = F.struct(*carried)
    if bounds:
        table = F.array(*[F.lit(b) for b in bounds])
        # The number of bounds below the id, by halving steps.
        steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
        place = let(table, lambda t: F.aggregate(
            F.array(*[F.lit(s) for s in steps]), F.lit(0),
            lambda at, s: F.when((at + s <= len(bounds)) & (F.get(t, at + s - 1) < F.col("id")), at + s).otherwise(at)))
        own = F.coalesce(place, F.lit(0))
        is_bound = F.get(table, F.col("bucket")) == F.col("id")
        placed = df.withColumn("bucket", own)
        homes = F.when(is_bound, F.array(F.struct(F.col("bucket"), F.lit(False).alias("extra")), F.struct(
            ((F.col("bucket") + 1) % len(bounds)).alias("bucket"), F.lit(True).alias("extra")))).otherwise(
            F.array(F.struct(F.col("bucket"), F.lit(False).alias("extra"))))
        dealt = placed.withColumn("home", F.explode(homes)).withColumns({"bucket": F.col("home.bucket"), "extra": F.col("home.extra")}).drop("home")
    else:
        dealt = df.withColumns({"bucket": F.lit(0), "extra": F.lit(False)})
    order = Window.partitionBy("bucket").orderBy("extra", F.col("id").desc_nulls_last(), F.xxhash64(*carried))
    follow = F.lead(follower).over(order)
    if not bounds:  # all ids are NULL
        follow = F.coalesce(follow, F.first(follower).over(order))
    return dealt.withColumn("next", follow).where(~F.col("extra")).select(
        *df.columns, *[F.col(f"next.{c}").alias(f"next_{c}") for c in carried])


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.0) -> DataFrame:
    """Per row of ``df``: ``id``, ``n_chars``, ``signatures``, ``edited`` (its text with the last half replaced by the start of the next
    document's, by descending id, the first after the last), ``edited_signatures``, ``near_edited`` and ``near_next`` (``likeness``).

    NULL text is empty. A table of one row follows itself; an empty table gives an empty result; other columns do not matter. Texts are taken whole, however long. Rows of
    one id are ordered by a hash of what they carry, so equal ones follow each other; NULL ids come last.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn(
        "signatures", signatures(F.col("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    paired = with_next(docs, ["text", "signatures"]).withColumn("n_chars", F.length("text").cast("long"))
    edited = paired.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                                  F.substring("next_text", F.lit(1), half)))
    edited = edited.withColumn("edited_signatures", signatures(F.col("edited")))
    return edited.select("id", "n_chars", "signatures", "edited", "edited_signatures",
                         likeness(F.col("signatures"), F.col("edited_signatures"), at_least).alias("near_edited"),
                         likeness(F.col("signatures"), F.col("next_signatures"), at_least).alias("near_next"))


def similar_classes(df: DataFrame, at_least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Members ``id``, ``class`` of the classes of equal fingerprints, and the pairs ``left``, ``right``, ``likeness`` of different classes that are ``at_least`` alike.

    A class stands for all rows of its fingerprint, so copies give no pairs; NULL and empty texts are one class, like nothing else. Every row of ``df`` is a member,
    repeated ids and NULL ones as well. An empty table has neither. ``at_least`` is above 0 and below 1.
    """
    if not 0 < at_least < 1:
        raise ValueError("at_least has to lie between 0 and 1")
    docs = materialise(df.select(F.col(id_col).alias("id"), signatures(F.col(text_col).cast("string")).alias("signatures")), "spots")
    classes = materialise(docs.select("signatures").distinct().withColumn("class", F.monotonically_increasing_id()), "spot-classes")
    members = docs.join(classes, "signatures").select("id", "class")
    n = F.size("signatures")
    each = classes.where(n > 0).select("class", n.alias("n"), length_partition(F.col("signatures"), at_least).alias("part"), F.explode("signatures").alias("s"))
    rarity = each.groupBy("s").agg(F.count("*").alias("known"))
    ordered = each.join(rarity, "s").groupBy("class", "n", "part").agg(F.sort_array(F.collect_list(F.struct("known", "s"))).alias("order"))
    # Two sets of similarity at_least share more than n - at_least * n of their signatures, so one of the rarest of each.
    rarest = F.slice("order", F.lit(1), (F.col("n") - F.ceil(at_least * F.col("n") - 1e-9) + 1).cast("int"))
    index = materialise(ordered.select("class", "n", "part", F.explode(rarest).alias("o")).select("class", "n", "part", F.col("o.s").alias("s")), "spot-index")
    probe = index.select(F.col("class").alias("a"), F.col("n").alias("n_a"), "s", F.col("part").alias("own"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    met = probe.join(index.withColumnsRenamed({"class": "b", "n": "n_b"}), ["s", "part"]).where(
        ((F.col("own") < F.col("part")) | (F.col("a") < F.col("b"))) & (F.least("n_a", "n_b") >= at_least * F.greatest("n_a", "n_b") - 1e-9))
    pairs = met.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right")).distinct()
    sets = [classes.select(F.col("class").alias(side), F.col("signatures").alias(f"of_{side}")) for side in ("left", "right")]
    compared = pairs.join(sets[0], "left").join(sets[1], "right").select("left", "right", likeness(F.col("of_left"), F.col("of_right"), at_least).alias("likeness"))
    return members, compared.where(F.col("likeness") >= at_least - 1e-12)
