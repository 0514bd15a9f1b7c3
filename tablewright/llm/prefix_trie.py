"""Trie of conversation prefixes from vertical bitmaps.

A node is a distinct sequence of first turns; its members are the conversations that start with it.

1. Conversations, as lists of turn digests, are dealt to shards by ranges of their ids. A shard keeps, for each (position, turn), the set of its
   conversations with that turn there as a bitset, and walks depth first: a node's bitset intersected with the postings of the next position gives its children, the
   popcount its members, and what ended there its end list. Nothing is compared turn by turn.
2. A node that one shard alone has is complete, and so is all below it. Nodes of several shards, the prefixes that many conversations share, are merged by
   the digest of their path: a hot prefix is one row per shard, however many conversations have it.
3. Sums over subtrees: those of complete nodes come from the walk. Merged nodes add up what lies below them by doubling: in round k each adds its sum to its
   ancestor 2**k above, so a chain of any depth needs as many rounds as its depth has bits.

The digest of a hot end list is taken while it streams by, shard after shard in ascending order of ids; it is never held.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import arrow_batches, words
from tablewright.session import materialise, release

ROOT = bytes(16)
NODE = ("path binary, parent binary, depth long, first long, parent_first long, n long, words long, n_children long, n_leaves long, saved long, "
        "ends array<long>, ends_sha256 string")
LAYOUT = pa.schema([
    ("path", pa.binary()), ("parent", pa.binary()), *((c, pa.int64()) for c in
    ("depth", "first", "parent_first", "n", "words", "n_children", "n_leaves", "saved")), ("ends", pa.list_(pa.int64())), ("ends_sha256", pa.string())])


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits that stand for a turn: of SHA-256 over role and text, told apart by the role's length. NULL counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)


def conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id`` (long) and ``turns``, an array of (``key``, ``words``) by turn, NULL first, equal turns by their digest.

    Texts stay where they are: a conversation is gathered as some 40 bytes a turn. Rows without ``conv_id`` belong to no conversation and are left out; repeated
    rows are repeated turns.
    """
    key = turn_digest(F.col(role_col), F.col(text_col))
    turns = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), key.alias("key"), F.size(words(F.col(text_col).cast("string"))).alias("words")).alias("t"))
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return gathered.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias("turns"))


def with_heads(convs: DataFrame, base: Column, n_turns: Column, most: int) -> DataFrame:
    """Each conversation with its first ``n_turns`` (0 to ``most``) turns replaced by those of the conversation ``base``: fewer if that has fewer, none if it is absent."""
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    own = convs.withColumns({"base": base, "h": n_turns.cast("int")})
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return own.join(heads, "base", "left").select(
        "conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def _ends_digest(lists) -> str:
    digest, first = hashlib.sha256(), True
    for ids in lists:
        if ids:
            digest.update(("" if first else ",").encode() + ",".join(map(str, ids)).encode())
            first = False
    return digest.hexdigest()


def _walk(ids: list[int], turns: list[list[dict]]) -> dict[str, list]:
    """All nodes of one shard; ``ids`` ascend."""
    postings, ended, weight = defaultdict(int), defaultdict(int), {}
    for i, conv in enumerate(turns):
        bit = 1 << i
        for place, turn in enumerate(conv):
            postings[place, turn["key"]] |= bit
            weight[turn["key"]] = turn["words"]
        ended[len(conv)] |= bit
    out = {f.name: [] for f in LAYOUT}
    above, nodes = [], 0
    stack = [((1 << len(ids)) - 1, 0, ROOT, None, 0)]
    while stack:
        members, depth, path, parent, n_words = stack.pop()
        at_end = members & ended[depth]
        rest = members ^ at_end
        children = 0
        while rest:
            key = turns[(rest & -rest).bit_length() - 1][depth]["key"]
            child = rest & postings[depth, key]
            rest ^= child
            children += 1
            stack.append((child, depth + 1, hashlib.sha256(path + key).digest()[:16], nodes, weight[key]))
        ends = [ids[i] for i in _bits(at_end)]
        n = members.bit_count()
        row = (path, None if parent is None else out["path"][parent], depth, ids[(members & -members).bit_length() - 1],
               None if parent is None else out["first"][parent], n, n_words, children, int(not children), (n - 1) * n_words, ends, _ends_digest([ends]))
        for column, value in zip(out.values(), row):
            column.append(value)
        above.append(parent)
        nodes += 1
    for i in range(nodes - 1, 0, -1):  # a node comes after its parent
        out["n_leaves"][above[i]] += out["n_leaves"][i]
        out["saved"][above[i]] += out["saved"][i]
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = _walk(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist())
            whole = pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in LAYOUT], schema=LAYOUT)
            for at in range(0, whole.num_rows, 10_000):
                yield whole.slice(at, 10_000)


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per path over rows sorted by path and first end: the state is one running hash."""
    def row(path, digest):
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([digest.hexdigest()])], names=["path", "ends_sha256"])

    path, digest = None, None
    for batch in batches:
        for p, ids in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
            text = ",".join(map(str, ids)).encode()
            if p == path:
                digest.update(b"," + text)
                continue
            if path is not None:
                yield row(path, digest)
            path, digest = p, hashlib.sha256(text)
    if path is not None:
        yield row(path, digest)


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """``shared`` (``path``, ``parent``, ``depth``, ``n_leaves``, ``saved`` of the node itself) with the two summed over subtrees, by doubling."""
    state = materialise(shared.select("path", F.col("parent").alias("up"), "n_leaves", "saved"), "trie-sums")
    for _ in range((shared.agg(F.max("depth")).first()[0] or 0).bit_length()):
        more = state.where("up IS NOT NULL").groupBy(F.col("up").alias("path")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        higher = state.where("up IS NOT NULL").select(F.col("path").alias("up"), F.col("up").alias("next"))
        after = materialise(state.join(more, "path", "left").join(higher, "up", "left").select(
            "path", F.col("next").alias("up"), (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-sums")
        release(state)
        state = after
    return state.drop("up")


def prefix_trie(convs: DataFrame, shard_size: int = 4096) -> DataFrame:
    """All nodes of the trie over ``convs`` (distinct ``conv_id``, and ``turns`` as of ``conversations``).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of the subtree, the node
    included), ``saved_tokens`` (over the subtree, members less one times the words of the node's last turn) and ``ends_sha256`` (of the ascending, comma-joined ids of the
    members that end at the node). A conversation without turns ends at the root. Equal conversations share all nodes. No conversations: no rows.
    """
    spark = convs.sparkSession
    with arrow_batches(spark, shard_size):
        nodes = materialise(convs.repartitionByRange("conv_id").sortWithinPartitions("conv_id").mapInArrow(_shards, NODE), "trie-shards")
        merged = nodes.groupBy("path").agg(
            F.count("*").alias("shards"), F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("first").alias("first"),
            F.sum("n").alias("n"), F.first("words").alias("words"))
        shared = materialise(merged.where("shards > 1"), "trie-shared")
        private = nodes.join(shared.select("path"), "path", "left_anti")
        below = private.groupBy(F.col("parent").alias("path")).agg(
            F.count("*").alias("own_children"), F.sum("n_leaves").alias("own_leaves"), F.sum("saved").alias("own_saved"))
        inner = shared.where("parent IS NOT NULL").groupBy(F.col("parent").alias("path")).agg(F.count("*").alias("shared_children"))
        none = F.lit(0).cast("long")
        children = F.coalesce("own_children", none) + F.coalesce("shared_children", none)
        counted = materialise(shared.join(below, "path", "left").join(inner, "path", "left").select(
            "path", "parent", "depth", "first", "n", children.alias("n_children"),
            F.when(children == 0, F.lit(1).cast("long")).otherwise(F.coalesce("own_leaves", none)).alias("n_leaves"),
            ((F.col("n") - 1) * F.col("words") + F.coalesce("own_saved", none)).alias("saved")), "trie-counted")
        digests = materialise(
            nodes.where(F.size("ends") > 0).join(shared.select("path"), "path", "left_semi").select("path", "ends")
            .repartition("path").sortWithinPartitions("path", F.get("ends", F.lit(0))).mapInArrow(_stream_digests, "path binary, ends_sha256 string"),
            "trie-ends")
        upper = counted.drop("n_leaves", "saved").join(_subtree_sums(counted), "path").join(digests, "path", "left").withColumn(
            "ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    names = shared.select(F.col("path").alias("parent"), F.col("first").alias("merged_first"))
    columns = ["first", "depth", "parent", "parent_first", "n", "n_children", "n_leaves", "saved", "ends_sha256"]
    both = private.select(*columns).unionByName(upper.withColumn("parent_first", F.lit(None).cast("long")).select(*columns))
    return both.join(names, "parent", "left").select(
        F.col("first").alias("conv_id"), "depth", F.coalesce("merged_first", "parent_first").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")
