import hashlib

import pytest
from pyspark.sql import functions as F

from tablewright.llm import spots
from tablewright.llm.queries import op7_spotsigs


def sets(text):
    return {text[i:i + 8] for i in range(0, len(text), 8)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """(id, characters, digest of the edited text) in the order of descending ids."""
    out = []
    for k, (doc, text) in enumerate(rows):
        follow, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        out.append((doc, len(text), hashlib.sha256((text[:len(text) - half] + follow[:half]).encode()).hexdigest()))
    return out


def test_query(spark, rows_of, sf_dir):
    rows = sorted(((i, t or "") for i, t, *_ in rows_of(sf_dir)), reverse=True)
    got = {r["doc_id"]: r for r in op7_spotsigs(spark, sf_dir).collect()}
    assert [(i, got[i]["n_chars"], got[i]["edited_sha256"]) for i, _ in rows] == expected(rows)
    by_text = {}
    for k, (i, t) in enumerate(rows):
        mine, edited, follow = (sets(x) for x in (got[i]["fingerprint"], got[i]["edited_fingerprint"], got[rows[(k + 1) % len(rows)][0]]["fingerprint"]))
        assert got[i]["near_edited"] == pytest.approx(jaccard(mine, edited)) and got[i]["near_next"] == pytest.approx(jaccard(mine, follow))
        assert by_text.setdefault(t, got[i]["fingerprint"]) == got[i]["fingerprint"]


def brute_signatures(text):
    import re
    words = [w for w in re.split(r"[^\w]+|_+", text.lower()) if w]
    content = [k for k, w in enumerate(words) if w not in spots.COMMON_WORDS]
    return [(words[k - 1], words[k], words[content[j + 1]]) for j, k in enumerate(content[:-1]) if k and words[k - 1] in spots.COMMON_WORDS]


def test_signatures_are_anchored_chains(spark, make):
    texts = ["At a rally to kick off a weeklong campaign for the south carolina primary.", "The house, and the garden of the house is big",
             "der Hund ist sehr groß und die Katze klein"]
    got = make(list(enumerate(texts))).select("doc_id", spots.signatures(F.col("text")).alias("s")).collect()
    chains = spark.createDataFrame([(i, *c) for i, t in enumerate(texts) for c in brute_signatures(t)], "i int, a string, b string, c string")
    want = {r["i"]: sorted(r["s"]) for r in chains.groupBy("i").agg(F.collect_set(F.hash("a", "b", "c")).alias("s")).collect()}
    assert {r["doc_id"]: r["s"] for r in got} == want and all(want.values())


def test_texts_without_anchors(make):
    rows = [(1, None), (2, ""), (3, "zzz"), (4, "zzz yyy xxx www"), (5, "***"), (6, "+++"), (7, "zzz yyy xxx vvv")]
    got = {r["doc_id"]: r["s"] for r in make(rows).select("doc_id", spots.signatures(F.col("text")).alias("s")).collect()}
    assert got[1] == got[2] == [] and len(got[3]) == 1 and len(got[4]) == 2 and got[5] != got[6]
    assert len(set(got[4]) & set(got[7])) == 1


@pytest.mark.parametrize("rows_per_bucket", [1, 4, 1000])
def test_next_document(make, rows_per_bucket):
    ids = [5, 90, 17, -3, 2 ** 40, 44, 45, 46, 47, 1, 0, 8]
    rows = sorted(((i, f"text {i} of the table number {i}") for i in ids), reverse=True)
    docs = make(rows).select("doc_id", "text").withColumnRenamed("doc_id", "id")
    got = {r["id"]: r["next_text"] for r in spots.with_next(docs, ["text"], rows_per_bucket).collect()}
    assert got == {i: rows[(k + 1) % len(rows)][1] for k, (i, _) in enumerate(rows)}


def test_edges(make, edge):
    got = spots.edited_fingerprints(make(edge)).collect()
    assert len(got) == len(edge)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and r["n_chars"] == len(r["edited"]) or r["n_chars"] >= len(r["edited"]) for r in got)
    single = spots.edited_fingerprints(make([(None, "a rally of the people on the hill")])).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0
    assert spots.edited_fingerprints(make([])).collect() == []


def test_pruning(spark):
    pairs = spark.createDataFrame([([1, 2, 3, 4], [1, 2]), ([1, 2, 3, 4], [1, 2, 3, 5]), ([], []), ([], [1])], "a array<int>, b array<int>")
    assert [r[0] for r in pairs.select(spots.likeness(F.col("a"), F.col("b"), 0.6)).collect()] == [0.0, 0.6, 1.0, 0.0]
    assert [r[0] for r in pairs.select(spots.likeness(F.col("a"), F.col("b"))).collect()] == [0.5, 0.6, 1.0, 0.0]
    sizes = spark.range(1, 400).select(F.col("id"), spots.length_partition(F.sequence(F.lit(1), F.col("id").cast("int")), 0.8).alias("p")).collect()
    part = {r["id"]: r["p"] for r in sizes}
    assert all(part[b] - part[a] in (0, 1) for a in part for b in part if a <= b and a >= 0.8 * b)


@pytest.mark.parametrize("at_least", [0.5, 0.8, 0.9])
def test_similar_classes_against_all_pairs(make, edge, at_least):
    import random
    from itertools import combinations
    rng = random.Random(4)
    words = ["the", "of", "a", *(f"w{i}" for i in range(60))]
    base = [[rng.choice(words) for _ in range(160)] for _ in range(12)]
    rows = [*edge]
    for i in range(150):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 5, 20])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((100 + i, " ".join(text[:rng.choice([160, 160, 140, 80])])))
    df = make(rows)
    members, pairs = spots.similar_classes(df, at_least)
    members, pairs = members.collect(), pairs.collect()
    found = df.select("doc_id", spots.signatures(F.col("text")).alias("s")).collect()
    assert sorted((str(r["id"]) for r in members)) == sorted(str(r["doc_id"]) for r in found)
    of_class = {}
    for r in members:
        of_class.setdefault(r["class"], []).append(r["id"])
    sets = {frozenset(r["s"]) for r in found}
    assert len(of_class) == len(sets)
    by_id = {r["doc_id"]: frozenset(r["s"]) for r in found if r["doc_id"] is not None}
    named = lambda c: by_id[next(i for i in of_class[c] if i is not None)]
    got = {frozenset((named(r["left"]), named(r["right"]))): r["likeness"] for r in pairs}
    want = {frozenset((a, b)): jaccard(a, b) for a, b in combinations(sets, 2) if a and b and jaccard(a, b) >= at_least - 1e-12}
    assert len(pairs) == len(got) and {k: pytest.approx(v) for k, v in want.items()} == got and want


def test_similar_classes_of_nothing(make):
    members, pairs = spots.similar_classes(make([(1, None)]).where("doc_id = 2"))
    assert members.count() == pairs.count() == 0
    with pytest.raises(ValueError):
        spots.similar_classes(make([(1, "a")]), 1.0)
