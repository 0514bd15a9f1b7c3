import random
import re

import duckdb
import pytest

from tablewright.llm import postings
from tablewright.llm.queries import ORACLES, op11_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    """Per document: words, words hit, distinct items found."""
    out = []
    for _, text in docs:
        words, hit, found = split(text), set(), set()
        for item, other in items:
            probe = split(other)
            n = min(size, len(probe))
            windows = {tuple(probe[i:i + n]) for i in range(len(probe) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if n and tuple(words[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found.add("" if item is None else str(item))
        out.append((len(words), len(hit), sorted(found)))
    return out


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefghij") * rng.choice((1, 1, 2))
    items = [(i, " ".join(word() for _ in range(rng.choice((3, 9, 10, 11, 25))))) for i in range(30)]
    items += [(90, None), (91, ""), (92, " ,; "), (93, "a"), (94, items[0][1]), (0, items[3][1]), (None, items[4][1]), (95, "Ä-ß 漢字,42")]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(60)]
    for i in range(60, 90):
        body = [word() for _ in range(40)]
        at = rng.randint(0, 40)
        docs.append((i, " ".join(body[:at]) + ", " + rng.choice(items[:30])[1].upper() + "! " + " ".join(body[at:])))
    return docs, items


def table_of(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")


@pytest.mark.parametrize("segment_words, block_words", [(1 << 20, 1 << 18), (50, 40), (1, 1)])
def test_against_brute_force(spark, make, edge, cases, segment_words, block_words):
    docs, items = cases
    rows = [*docs, *edge, (None, items[2][1]), (None, items[2][1])]
    index = postings.build_index(make(rows), segment_words=segment_words)
    got = postings.contamination(index, table_of(spark, items), block_words=block_words).collect()
    want = [(i, *x) for (i, _), x in zip(rows, brute(rows, items))]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["id"], r["n_words"], r["n_hit"], list(r["items"])) for r in got), key=key) == sorted(want, key=key)


def test_phrase_matches_are_runs_of_windows(spark, make):
    text = "x y " + " ".join(f"w{i}" for i in range(12)) + " z " + " ".join(f"w{i}" for i in range(1, 11)) + " q"
    index = postings.build_index(make([(5, text), (6, "w0 w1 w2"), (7, None)]))
    items = table_of(spark, [(1, " ".join(f"w{i}" for i in range(12))), (2, "w0 W1"), (3, "")])
    got = {(r["id"], r["item"], r["first"], r["last"]) for r in postings.phrase_matches(index, items, window=10).collect()}
    assert got == {(5, 1, 2, 13), (5, 1, 15, 24), (5, 2, 2, 3), (6, 2, 0, 1)}


def brute_near(docs, items, within):
    out = set()
    for doc, text in docs:
        words = split(text)
        for item, other in items:
            terms = set(split(other))
            if terms:
                holds = [(a, b) for a in range(len(words)) for b in range(a, min(len(words), a + within)) if terms <= set(words[a:b + 1])]
                out |= {(doc, item, a, b) for a, b in holds if not any((c, d) != (a, b) and a <= c and d <= b for c, d in holds)}
    return out


@pytest.mark.parametrize("segment_words", [1 << 20, 70])
def test_proximity(spark, make, cases, segment_words):
    docs = cases[0]
    items = [(1, "a b"), (2, "b A cc"), (3, "a"), (4, "nothere a"), (5, None), (6, "jj ii hh gg")]
    index = postings.build_index(make(docs), segment_words=segment_words)
    got = {(r["id"], r["item"], r["first"], r["last"]) for r in postings.proximity_matches(index, table_of(spark, items), within=8).collect()}
    assert got == brute_near(docs, items, 8) and {i for _, i, *_ in got} >= {1, 2, 3}


def test_long_text_is_cut_between_words(monkeypatch):
    from collections import defaultdict
    from itertools import count
    text = ("Word Über x1, " * 500).encode()
    whole = list(postings.word_numbers(text, defaultdict(count().__next__)))
    monkeypatch.setattr(postings, "SLICE", 7)
    assert list(postings.word_numbers(text, defaultdict(count().__next__))) == whole and len(whole) == 1500


def test_candidates_in_chunks(spark, make, monkeypatch):
    table = postings.build_index(make([(1, "a b " * 50)]), segment_words=1 << 20).where("term IS NULL OR term IN ('a', 'b')").toArrow()
    monkeypatch.setattr(postings, "CHUNK", 3)
    import numpy as np
    import pyarrow as pa
    segment = postings.Segment(table, pa.array(["a", "b"]), 4)
    window, place = segment.phrases(np.array([[0, 1], [1, 0]]))
    assert sorted(zip(window, place)) == [*((0, i) for i in range(0, 100, 2)), *((1, i) for i in range(1, 99, 2))]


def test_terms_times_places_pass_32_bits(spark, make):
    words = [f"w{i}" for i in range(60_000)]
    index = postings.build_index(make([(1, " ".join(words)), (2, " ".join(words[59_000:59_009])), (3, " ".join(words[50_000:50_015] + ["z"]))]))
    items = spark.createDataFrame([(i, " ".join(words[i:i + 10])) for i in range(0, 60_000, 10)], "item_id long, text string")
    got = {r["id"]: r for r in postings.contamination(index, items).collect()}
    assert [(r["n_words"], r["n_hit"], len(r["items"])) for r in (got[1], got[2], got[3])] == [(60_000, 60_000, 6_000), (9, 0, 0), (16, 10, 1)]
    runs = {(r["id"], r["item"], r["first"], r["last"]) for r in postings.phrase_matches(index, items).collect()}
    assert runs == {(3, 50_000, 0, 9), *((1, i, i, i + 9) for i in range(0, 60_000, 10))}


def test_query_and_empty_tables(spark, sf_dir, tmp_path):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted(tuple(r[c] for c in columns) for r in op11_decontamination(spark, sf_dir).collect())
    assert got == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op11_decontamination']})").fetchall())
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert op11_decontamination(spark, str(tmp_path)).count() == 0
    index = postings.build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    none = postings.contamination(index, spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    assert {(r["n_hit"], len(r["items"])) for r in none.collect()} == {(0, 0)}
