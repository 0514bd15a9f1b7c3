import random
import re

import numpy as np
import pytest
import xxhash

from tablewright.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, ids, bits):
    """Least id of the component of each row, by union over all pairs."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    array = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= bits):
            root[find(int(j))] = find(i)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(fps))]


def test_documents(spark, make, edge, rows_of, sf_dir):
    rows = [r[:2] for r in rows_of(sf_dir)] + [(None if i is None else i + 1000, t) for i, t in edge]
    fps = [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip((i for i, _ in rows), fps, groups(fps, [i for i, _ in rows], 2)), key=str)
    got = sorted(((r["id"], r["fp"] % 2**64, r["component"]) for r in simhash.near_duplicates(make(rows)).collect()), key=str)
    assert got == want


def test_fingerprint_is_of_spark_hashes(spark):
    text = "one two three"
    want = spark.sql(f"SELECT xxhash64('{text}')").first()[0] % 2**64
    assert simhash.fingerprint(text.encode()) == want == brute_fingerprint(text)


def planted(seed, n, near):
    """Fingerprints with neighbours of 1 to 3 bits, chains, and a dense ball around one of them."""
    rng = random.Random(seed)
    fps = {0, 2**64 - 1}
    for _ in range(n):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(rng.randint(0, 3)):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 3)):
                g ^= 1 << b
            fps.add(g)
            f = g if rng.random() < 0.5 else f
    centre = rng.getrandbits(64)
    for _ in range(near):
        g = centre
        for b in rng.sample(range(64), rng.randint(0, 4)):
            g ^= 1 << b
        fps.add(g)
    return sorted(fps)


@pytest.mark.parametrize("bits,cap", [(2, 16), (2, 2), (1, 16), (1, 2), (2, 10_000)])
def test_links_connect_all_near_pairs(spark, bits, cap):
    fps = planted(bits * 10 + cap, 150, 250)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    links = simhash.links(distinct, bits, cap)
    pairs = [(r["a"], r["b"]) for r in links.collect()]
    assert all((a ^ b).bit_count() <= bits if (a < 0) == (b < 0) else ((a % 2**64) ^ (b % 2**64)).bit_count() <= bits for a, b in pairs)
    roots = {r["fp"]: r["root"] for r in simhash.components(links).collect()}
    assert [roots.get(f, f) for f in signed] == groups(fps, signed, bits)


def test_pairs_are_reported_once(spark):
    fps = planted(5, 200, 0)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    spread = distinct.mapInArrow(simhash._variants, "key long, fp long")
    matched = spread.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(simhash._matcher(1000, 2), "a long, b long")
    got = [tuple(r) for r in matched.collect()]
    array = np.array(fps, np.uint64)
    want = sum(int((np.bitwise_count(array[i + 1:] ^ f) <= 2).sum()) for i, f in enumerate(array))
    assert len(got) == len(set(got)) == want


def test_long_runs_cross_batches(spark):
    """A run longer than the cap hands on every member once, however batches cut it."""
    import pyarrow as pa
    keys = [1] * 3 + [2] * 9 + [3] * 2 + [4] * 20 + [5]
    fps = list(range(len(keys)))
    for size in (1, 2, 5, 100):
        batches = [pa.RecordBatch.from_pydict({"key": pa.array(keys[i:i + size], pa.int64()), "fp": pa.array(fps[i:i + size], pa.int64())})
                   for i in range(0, len(keys), size)]
        hot = [a for b in simhash._matcher(4, 2)(iter(batches)) for a, p in zip(b["a"].to_pylist(), b["b"].to_pylist()) if p is None]
        assert sorted(hot) == [f for k, f in zip(keys, fps) if k in (2, 4)]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(2000, 2001), (2001, 2000)]
    got = {r["fp"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[i] == 1000 for i in range(1001, 1200)) and got[2001] == 2000


def test_empty_table(make):
    assert simhash.near_duplicates(make([])).collect() == []
