import random
import re
from collections import Counter

import pytest

from tablewright.llm import collocations

LOWER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(docs, min_count, top=2000, covered=80):
    counts, totals = {}, Counter()
    for lang, text in docs:
        f = counts.setdefault(lang or "und" if lang != "" else "", Counter())
        for w in pieces(text):
            totals[lang if lang is not None else "und"] += len(w)
            f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) >= 2 and a >= min_count}
        around = Counter()
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i:i + k]] = max(around[p[i:i + k]], a)
        scored = []
        for p, a in cands.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            if not (around[p] and 100 * around[p] >= covered * a):
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture(scope="module")
def corpus(edge):
    rng = random.Random(11)
    words = ["the", "THE", "of", "New", "york", "city", "Ä", "x-y", "\x00", "a b", *(f"r{i}" for i in range(300))]
    weights = [30, 5, 20, 8, 8, 8, 4, 4, 3, 3, *[0.3] * 300]
    docs = []
    for i in range(400):
        body = rng.choices(words, weights, k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for w in body)
        docs.append((i, text + " new york city" * rng.randint(0, 2), rng.choice(["en", "en", "en", "de", None, ""])))
    docs += [(i, "same phrase in many copies of it", "fr") for i in range(300)]
    return docs + [(i, t, None) for i, t in edge]


@pytest.mark.parametrize("parts, top, min_count", [(8, 2000, 5), (1, 3, 30), (500, 2000, 2)])
def test_against_brute_force(spark, make, corpus, parts, top, min_count):
    docs = make([(i, t, lang) for i, t, lang in corpus])
    got = rows(collocations.collocations(docs, min_count=min_count, top=top, parts=parts))
    assert got == brute([(lang, t) for _, t, lang in corpus], min_count, top) and len(got) > 4


def test_small_slices_and_chunks(corpus, monkeypatch):
    """Tasks see the constants of the driver only through closures, so the counting runs here in one process."""
    import pyarrow as pa
    from itertools import chain
    batch = pa.RecordBatch.from_pylist([{"lang": lang or "und", "text": t} for _, t, lang in corpus if lang != ""])
    whole = Counter()
    for lang, numbers, words in collocations._chunks(iter([batch])):
        for n in numbers[numbers > 0]:
            whole[lang, words[n - 1]] += 1
    monkeypatch.setattr(collocations, "SLICE", 16)
    monkeypatch.setattr(collocations, "CHUNK", 50)
    split = Counter()
    for lang, numbers, words in collocations._chunks(iter([batch])):
        for n in numbers[numbers > 0]:
            split[lang, words[n - 1]] += 1
    want = Counter((lang or "und", w.encode()) for _, t, lang in corpus if lang != "" for w in chain(*pieces(t)))
    assert whole == split == want


def test_a_shared_bit_changes_nothing(spark, make, corpus, monkeypatch):
    monkeypatch.setattr(collocations, "pair_bitmap", lambda pairs: b"\xff" * (1 << 13))
    docs = make([(i, t, lang) for i, t, lang in corpus])
    assert rows(collocations.collocations(docs, min_count=5)) == brute([(lang, t) for _, t, lang in corpus], 5)


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([(9 * 10 ** 15, 10 ** 16, 9 * 10 ** 15)], "a long, l long, r long")
    got = counts.selectExpr("cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) AS s").first()[0]
    assert got == 2_000_000 * 9 * 10 ** 15 // (10 ** 16 + 9 * 10 ** 15)


def test_empty_table(spark, make):
    assert rows(collocations.collocations(make([(1, "a b", "en")]).where("doc_id = 2"))) == []
    assert rows(collocations.collocations(make([(1, None, "en"), (2, " . ", "en")]), min_count=1)) == []
