import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import line_dedup as ld

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_docs):
    lower = {c: c + 32 for c in range(65, 91)}
    split = [(i, (t or "").split("\n")) for i, t in rows]
    keys = [[x.strip(SPACE).translate(lower) for x in lines] for _, lines in split]
    found = Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for (i, lines), ks in zip(split, keys):
        kept = [x for x, k in zip(lines, ks) if not (k and found[k] >= min_docs)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df, **options):
    got = ld.drop_repeated_lines(df, keep={"doc_id": F.col("doc_id")}, **options)
    return sorted(((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in got.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"shard_keys": 8}, {"shard_keys": 8, "budget": 1}])
def test_equals_brute_force(spark, make, edge, rows_of, sf_dir, options):
    rows = [r[:2] for r in rows_of(sf_dir)] + edge
    rows += [(1000 + i, f"  Shared LINE \t\nown {i}\nshared line\n{'x' * (i % 3)}") for i in range(30)]
    assert result(make(rows), min_docs=3, **options) == brute(rows, 3)


def test_threshold_is_exact(make):
    rows = [(i, "nine\nten" if i < 9 else "ten") for i in range(10)] + [(99, "NINE nine\n ten ")]
    assert result(make(rows), min_docs=10) == brute(rows, 10)
    assert dict((r[0], r[2]) for r in result(make(rows), min_docs=10))[99] == 1


def test_empty_table(make):
    assert result(make([])) == []


def test_perfect_hash_is_minimal_and_survives_a_round_trip():
    keys = np.random.default_rng(0).integers(0, 2**64, 20_000, dtype=np.uint64)
    perfect = ld.PerfectHash.load(*ld.PerfectHash.build(keys).dump())
    assert sorted(perfect.numbers(keys)) == list(range(len(keys)))
    with pytest.raises(ValueError):
        ld.PerfectHash.build(np.array([5, 5], np.uint64))


def test_keys_outside_the_index_are_not_found(spark, make, tmp_path):
    rows = [(i, "\n".join(f"line {k}" for k in range(i, i + 40))) for i in range(60)]
    path, shards, _ = ld.build_index(ld.count_keys(make(rows), "text"), 10, 16)
    index = ld.Index(path, shards, 1 << 20)
    inside = ld.line_hashes([b"line 50"])
    outside = ld.line_hashes([f"other {k}".encode() for k in range(5000)] + [b"line 0"])
    assert index.counts(inside).tolist() == [40] and not index.counts(outside).any()
