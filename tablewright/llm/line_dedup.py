"""Line deduplication with a sharded minimal perfect hash.

A line's key is the line without white space at both ends and with A-Z lower-cased. Keys found in ``min_docs`` documents or more lose
all their lines.

1. Each document sends the 128-bit hashes of its distinct keys; a combinable count gives the documents per key.
2. Keys with enough documents are dealt to shards by their hash. Each shard builds a minimal perfect hash over its keys (levels of
   bit arrays: a key that lands alone on a bit stays there, the others go on to the next level; the rank of its bit is
   the key's number) and two arrays by that number: the other 64 bits of the hash as fingerprint, and the count.
3. Documents probe the arrays: no line is joined or shuffled again. A key that is not in the index meets a
   fingerprint that is not its own.

A shard holds about ``shard_keys`` keys. Tasks load shards from the shared folder and hold at most ``budget`` bytes of
them at a time; a larger index passes through each batch of documents group by group. Whatever the index, no line is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import SPACES, batch_rows, filesystem, text_batches
from tablewright.session import scratch_path

TRIM = SPACES.encode()
LOAD = 1.6  # bits per key on each level of the hash
LEVELS = 40
MAX_COUNT = 2**32 - 1


def key_of(line: bytes) -> bytes:
    return line.strip(TRIM).lower()


def line_hashes(lines: list[bytes]) -> np.ndarray:
    """(lines, 2) unsigned: the 128-bit hash of each key; an empty key has (0, 0)."""
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(k) if (k := line.strip(TRIM)) and (k := k.lower()) else bytes(16) for line in lines])
    return np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)


def _spread(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each key on a level: a multiply-shift mix, scaled to ``size``."""
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return ((x >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct 64-bit keys. ``levels``: one boolean array per level."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits, dtype=np.int64) - bits + total)
            total += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            if len(levels) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(64, int(len(keys) * LOAD))
            place = _spread(keys, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[place]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key. For other keys: any number, or -1."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for i, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(open_):
                break
            place = _spread(keys[open_], i, len(bits))
            hit = bits[place]
            found[open_[hit]] = ranks[place[hit]]
            open_ = open_[~hit]
        return found

    def dump(self) -> tuple[list[int], bytes]:
        return [len(b) for b in self.levels], b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def load(cls, sizes: list[int], data: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            n = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, n, at), count=size).astype(bool))
            at += n
        return cls(levels)


def count_keys(df: DataFrame, text_col: str) -> DataFrame:
    """``h1``, ``h2``, ``n``: documents of ``df`` in which each key occurs. Empty keys are left out."""
    batch_rows(df.sparkSession, 500)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_batches(batches, "text"):
            lines, owner = [], []
            for i, text in enumerate(texts):
                some = (text or b"").split(b"\n")
                lines += some
                owner.append(len(some))
            hashes = line_hashes(lines)
            docs = np.repeat(np.arange(len(texts)), owner)
            order = np.lexsort((docs, hashes[:, 1], hashes[:, 0]))
            h, d = hashes[order], docs[order]
            new_key = np.append(True, (h[1:] != h[:-1]).any(axis=1))
            new = new_key | np.append(True, d[1:] != d[:-1])
            starts = np.flatnonzero(new_key)
            n = np.add.reduceat(new.astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
            keep = h[starts].any(axis=1)
            out = h[starts][keep].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1]), pa.array(n[keep])], names=["h1", "h2", "n"])

    counts = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "h1 long, h2 long, n long")
    return counts.groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def _shard(rows: pd.DataFrame) -> pd.DataFrame:
    # Equal first halves of two 128-bit hashes would have no perfect hash; a key is then told apart by its second half.
    h1, h2 = (rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    keys = h1 ^ (h2 << np.uint64(1))
    perfect = PerfectHash.build(keys)
    number = perfect.numbers(keys)
    prints, counts = np.empty(len(keys), "<u8"), np.empty(len(keys), "<u4")
    prints[number], counts[number] = h2, np.minimum(rows["n"].to_numpy(), MAX_COUNT)
    sizes, bits = perfect.dump()
    return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "sizes": [sizes], "bits": [bits], "prints": [prints.tobytes()],
                         "counts": [counts.tobytes()]})


def build_index(counts: DataFrame, min_docs: int, shard_keys: int) -> tuple[str, int, int]:
    """Write the shards of the keys in ``min_docs`` documents or more; returns folder, number of shards and bytes."""
    spark = counts.sparkSession
    keys_path = scratch_path(spark, "line-keys")
    counts.where(F.col("n") >= min_docs).write.parquet(keys_path)
    keys = spark.read.schema("h1 long, h2 long, n long").parquet(keys_path)
    total = keys.count()
    shards = max(1, -(-total // shard_keys))
    path = scratch_path(spark, "line-index")
    shard = F.pmod(F.col("h1"), F.lit(shards)).cast("long")
    keys.withColumn("shard", shard).groupBy("shard").applyInPandas(
        _shard, "shard long, sizes array<long>, bits binary, prints binary, counts binary").write.parquet(path)
    return path, shards, total * 13


class Index:
    """The shards of a folder, in groups of at most ``budget`` bytes."""

    def __init__(self, path: str, shards: int, budget: int):
        self.path, self.shards, self.budget, self.only = path, shards, budget, None

    def groups(self) -> Iterator[dict[int, tuple[PerfectHash, np.ndarray, np.ndarray]]]:
        if self.only is not None:
            yield self.only
            return
        group, size, n_groups = {}, 0, 0
        for shard, perfect, prints, counts in self._read():
            more = prints.nbytes + counts.nbytes + sum(b.nbytes + r.nbytes for b, r in zip(perfect.levels, perfect.ranks))
            if group and size + more > self.budget:
                n_groups += 1
                yield group
                group, size = {}, 0
            group[shard], size = (perfect, prints, counts), size + more
        if n_groups == 0:
            self.only = group  # all of it fits: kept for the next batches
        yield group

    def _read(self):
        fs, path = filesystem(self.path)
        import pyarrow.fs as pafs
        files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet"))
        for file in files:
            with fs.open_input_file(file) as source:
                for batch in pq.ParquetFile(source).iter_batches(batch_size=4):
                    for r in batch.to_pylist():
                        yield (r["shard"], PerfectHash.load(r["sizes"], r["bits"]), np.frombuffer(r["prints"], "<u8"),
                               np.frombuffer(r["counts"], "<u4"))

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Documents of each hashed key, 0 for keys outside the index."""
        found = np.zeros(len(hashes), np.int64)
        keys = hashes[:, 0] ^ (hashes[:, 1] << np.uint64(1))
        shard = np.mod(hashes[:, 0].view(np.int64), self.shards)
        for group in self.groups():
            for number, (perfect, prints, counts) in group.items():
                mine = np.flatnonzero(shard == number)
                place = perfect.numbers(keys[mine])
                ok = place >= 0
                mine, place = mine[ok], place[ok]
                same = prints[place] == hashes[mine, 1]
                found[mine[same]] = counts[place[same]]
        return found


def drop_repeated_lines(df: DataFrame, text_col: str = "text", min_docs: int = 10, keep: dict[str, Column] | None = None,
                        shard_keys: int = 1 << 16, budget: int = 128 << 20) -> DataFrame:
    """Per row of ``df``: the columns ``keep``, ``n_lines``, ``n_dropped`` and ``kept_text``.

    * Lines are what ``\\n`` separates; a NULL or empty text is one empty line, which is kept. A blank line has no key and stays.
    * A row counts as one document however often a key is repeated in it; repeated rows count each.
    * A text whose lines all go becomes the empty text. An empty table gives an empty result.
    * Texts are taken whole, however long; NULL and repeated ids do not matter, nor do other columns, but ``keep`` may not name one ``__text``.
    """
    path, shards, _ = build_index(count_keys(df, text_col), min_docs, shard_keys)
    batch_rows(df.sparkSession, 500)
    keep = keep or {}
    index = Index(path, shards, budget)
    kept_names = list(keep)
    chosen = df.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).cast("string").alias("__text"))
    schema = chosen.drop("__text").schema.add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "__text"):
            split = [(t or b"").split(b"\n") for t in texts]
            sizes = np.array([len(s) for s in split], np.int64)
            hashes = line_hashes([x for s in split for x in s])
            drop = (index.counts(hashes) >= min_docs) & hashes.any(axis=1)
            ends = np.cumsum(sizes)
            dropped = np.add.reduceat(drop.astype(np.int64), ends - sizes) if len(sizes) else sizes
            kept = [b"\n".join([x for x, d in zip(s, drop[e - n:e]) if not d]) if k else (t or b"")
                    for s, t, n, e, k in zip(split, texts, sizes, ends, dropped)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in kept_names] + [pa.array(sizes), pa.array(dropped), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*kept_names, "n_lines", "n_dropped", "kept_text"])

    return chosen.mapInArrow(run, schema)
