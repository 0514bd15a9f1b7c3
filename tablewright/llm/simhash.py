"""Near duplicates by 64-bit SimHash and deletion-variant signatures.

Fingerprints that differ in at most ``2`` bits are linked. Cut into two segments of 32 bits, two such fingerprints have a
segment that differs in at most one bit. Each segment is indexed under its 32 variants with one bit left out, so
that segment is found by equality of a variant; candidates are verified over all 64 bits, and of the variants
that a pair shares only one reports it.

A variant that more than ``cap`` distinct fingerprints share would give pairs in the square of their number. Its fingerprints
are linked in another exact way: each is put under itself and under its 64 one-bit changes. Two fingerprints
within two bits share such a value, and all that share one are within two bits of each other, so each
is linked to the least of them and no pair is lost or enumerated.

Components: links between distinct fingerprints only. Rounds of hooking to the least neighbour and jumping to the
representative of the representative, each round written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import batch_rows, text_batches
from tablewright.session import materialise, release

SEED = 42
BITS = 64
HALF = 32
CHUNK = 1 << 15  # shingles whose bits are unpacked at once


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of whole ``text`` (UTF-8): a bit is set if more than half of the shingle hashes have it; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:])])
    bits = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(bits), CHUNK):
        ones += np.unpackbits(bits[i:i + CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(bits)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """``id`` and ``fp`` (the fingerprint as a signed long) of each row; NULL text counts as empty."""
    batch_rows(df.sparkSession, 500)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            found = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], names=["id", "fp"])

    id_type = df.select(id_col).schema[0].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {id_type}, fp long")


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """64 rows per fingerprint: (segment, left-out bit, rest of the segment) in one long."""
    bit = np.arange(HALF, dtype=np.uint64)
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for i in range(0, len(fps), 4096):
            some = fps[i:i + 4096]
            parts = np.stack([some & np.uint64(0xFFFFFFFF), some >> np.uint64(HALF)])
            masked = parts[:, :, None] & ~(np.uint64(1) << bit)
            head = (np.arange(2, dtype=np.uint64)[:, None, None] * np.uint64(HALF) + bit) << np.uint64(HALF)
            key = (masked | head).reshape(-1).view(np.int64)
            fp = np.broadcast_to(some[None, :, None], masked.shape).reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])


def _verified(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbours within runs of equal keys, at every distance within a run, that differ in at most ``max_bits``."""
    left, right, step = [], [], 1
    while True:
        same = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(same):
            break
        a, b = fps[same].view(np.uint64), fps[same + step].view(np.uint64)
        diff = a ^ b
        place = keys[same].view(np.uint64) >> np.uint64(HALF)
        low, high = diff & np.uint64(0xFFFFFFFF), diff >> np.uint64(HALF)
        mine = np.where(place < HALF, low, high)
        # The variant that reports: of the first segment that can, at its differing bit, or at bit 0 if it is equal.
        bit = np.where(mine == 0, np.uint64(0), np.uint64(1) << (place % np.uint64(HALF)))
        reports = np.where(mine == 0, place % HALF == 0, mine == bit) & ((place < HALF) | (np.bitwise_count(low) > 1))
        ok = reports & (np.bitwise_count(diff) <= max_bits)
        left.append(a[ok])
        right.append(b[ok])
        step += 1
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)


def _matcher(cap: int, max_bits: int):
    """Over rows sorted by key: verified pairs of runs of at most ``cap``; of longer runs each member with a NULL partner.

    A run is held until it ends or passes ``cap``; a longer one is passed on as it comes.
    """
    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f, hot = np.empty(0, np.int64), np.empty(0, np.int64), None

        def settle(keys, fps):
            size = np.diff(np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys)))
            large = np.repeat(size > cap, size)
            many = fps[large]
            some = [(many, [None] * len(many))] if len(many) else []
            pairs = _verified(keys[~large], fps[~large], max_bits)
            return some + ([pairs] if len(pairs[0]) else [])

        for batch in batches:
            keys = np.concatenate([held_k, batch.column("key").to_numpy()])
            fps = np.concatenate([held_f, batch.column("fp").to_numpy()])
            if hot is not None:  # the run at the end of the last batch was passed on already
                n = int(np.searchsorted(keys != hot, True)) if (keys != hot).any() else len(keys)
                if n:
                    yield out(fps[:n], [None] * n)
                keys, fps = keys[n:], fps[n:]
                if not len(keys):
                    continue
                hot = None
            if not len(keys):
                continue
            last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
            if len(keys) - last > cap:
                hot = keys[-1]
                yield out(fps[last:], [None] * (len(keys) - last))
                held_k, held_f = np.empty(0, np.int64), np.empty(0, np.int64)
            else:
                held_k, held_f = keys[last:], fps[last:]
            if last:
                for a, b in settle(keys[:last], fps[:last]):
                    yield out(a, b)
        if len(held_k):
            for a, b in settle(held_k, held_f):
                yield out(a, b)

    return run


def links(distinct: DataFrame, max_bits: int = 2, cap: int = 16) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` that connect all pairs within ``max_bits`` (1 or 2) bits."""
    batch_rows(distinct.sparkSession, 20_000)
    spread = distinct.mapInArrow(_variants, "key long, fp long")
    matched = materialise(spread.repartition("key").sortWithinPartitions("key", "fp")
                          .mapInArrow(_matcher(cap, max_bits), "a long, b long"), "simhash-links")
    pairs = matched.where("b IS NOT NULL")
    hot = matched.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    # One-bit changes: for two bits each also meets the other's changes, for one bit a change meets the other itself.
    changes = F.array(*[F.col("fp").bitwiseXOR(F.lit(np.int64(np.uint64(1) << np.uint64(i)).item())) for i in range(BITS)])
    near = hot.select("fp", F.explode(F.concat(F.array("fp"), changes)).alias("near"))
    if max_bits >= 2:
        least = near.groupBy("near").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("near", "b")
        stars = near.join(least, "near").select(F.col("fp").alias("a"), "b").where("a != b")
    else:
        stars = near.where("near != fp").select(F.col("near").alias("a"), F.col("fp").alias("b")).join(
            hot.select(F.col("fp").alias("a")), "a", "left_semi")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``fp`` and ``root``, the least fingerprint reachable, for every fingerprint with a link.

    A round turns the links of each node to its least neighbour: first those to larger nodes, then those to smaller ones.
    The links become stars in a number of rounds that grows with the logarithm of the longest chain. A node's minimum is
    a combinable aggregate, and the join that spreads it can be split, so a node with very many links is no hot group.
    """
    current = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    for _ in range(max_rounds):
        # u > v throughout. Larger neighbours of each node go to the least of the node and its neighbours.
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Smaller neighbours, and the node itself, go to the least of them.
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        after = materialise(small, "edges")
        # Stars: every node has one link, and no root is linked further.
        counts = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        before = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        release(current)
        current = after
        if counts == before:
            return current.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 2, shingle: int = 3,
                    cap: int = 16) -> DataFrame:
    """``id``, ``fp`` and ``component`` (the least id reachable through links) of each row of ``df``.

    * Text: NULL, empty and blank texts have fingerprint 0 and are linked like any other. Texts are never cut.
    * Equal rows are equal fingerprints and need no link. A NULL id takes part; it is the component's name only
      where the component has no other id.
    * An empty table gives an empty result; columns other than the two named do not matter.
    """
    hashed = materialise(fingerprints(df, id_col, text_col, shingle), "simhash")
    distinct = hashed.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(distinct.select("fp"), max_bits, cap))
    joined = distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    names = joined.groupBy("root").agg(F.min("least").alias("component"))
    return hashed.join(joined.select("fp", "root").join(names, "root").select("fp", "component"), "fp")
