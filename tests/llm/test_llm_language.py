import zlib

import pytest
from pyspark.sql import functions as F

from tablewright.llm import language
from tablewright.llm.queries import op2_language


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    got = op2_language(spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_edges(make, edge, rows_of, sf_dir):
    training = make(rows_of(sf_dir) + [(900, "no language", None), (901, "123", "xx"), (902, None, "yy")])
    got = language.identify(make(edge), training, keep={"doc_id": F.col("doc_id")}).collect()
    assert len(got) == len(edge)
    blank = {1, 2, 3, 12}
    assert all((r["lang_pred"] == "und" and r["score"] == 0) == (r["doc_id"] in blank) for r in got if r["doc_id"] is not None)
    assert {r["lang_pred"] for r in got} <= {"de", "en", "es", "fr", "und"}
    same = [tuple(r)[1:] for r in got if r["doc_id"] in (6, 7)]
    assert same[0] == same[1]


def test_nothing_learnt_and_empty_table(make):
    got = language.identify(make([(1, "hello there")]), make([]), keep={"doc_id": F.col("doc_id")}).collect()
    assert [tuple(r) for r in got] == [(1, "und", 0.0)]
    assert language.identify(make([]), make([(1, "hello", "en")])).collect() == []
    with pytest.raises(ValueError):
        language.identify(make([]), make([(1, "hello", "en"), (2, "hallo", "de")]), max_languages=1)


def test_bundles_do_not_depend_on_the_batch():
    texts = [b"the quick brown fox", "über den Fluß".encode(), b"", "漢字かな".encode()]
    together = language.bundles(texts)
    assert all((language.bundles([t])[0] == v).all() for t, v in zip(texts, together))
    assert not together[2].any() and together[3].any()


def brute_letters(seed=11):
    """The random vector of each class of letters, as drawn for the given seed; the rest is written out below."""
    import numpy as np
    return (np.random.default_rng(seed).integers(0, 2, (128, 1024)).astype(int) * 2 - 1).tolist()


def brute_class(c):
    if not c.isalpha():
        return 0
    low = c.lower()[0]
    return ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 2654435761 >> 8) % 101


def brute_bundle(text, letters):
    """Bind and bundle letter by letter: rotate, multiply, add."""
    classes = [brute_class(c) for c in text]
    total = [0] * 1024
    if not any(classes):
        return total
    row = [0]
    for c in [*classes, 0]:
        if c or row[-1]:
            row.append(c)
    for a, b, c in zip(row, row[1:], row[2:]):
        for d in range(1024):
            # A vector rotated by r places has at d what was at d - r.
            total[d] += letters[a][(d - 2) % 1024] * letters[b][(d - 1) % 1024] * letters[c][d]
    return total


def brute_unit(v):
    length = sum(x * x for x in v) ** 0.5
    return [x / length for x in v] if length else list(v)


def test_against_brute_force(make):
    letters = brute_letters()
    training = [(1, "the cat and the dog", "en"), (2, "this is the end of it", "en"), (3, "der Hund und die Katze", "de"), (4, "das ist nicht schön", "de"),
                (5, "le chien et le chat", "fr"), (6, "c'est la fin", "fr"), (7, "42", "xx")]
    texts = [(10, "the end of the dog"), (11, "die schöne Katze"), (12, "la fin du chien"), (13, "x"), (14, "漢字 and the"), (15, "  "), (16, None)]
    sums = {}
    for _, text, lang in training:
        unit = [round(x * (1 << 20)) for x in brute_unit(brute_bundle(text, letters))]
        sums[lang] = [a + b for a, b in zip(sums.get(lang, [0] * 1024), unit)]
    known = {k: brute_unit(v) for k, v in sorted(sums.items()) if any(v)}
    centre = [sum(v[d] for v in known.values()) / len(known) for d in range(1024)]
    compare = {k: brute_unit([a - b for a, b in zip(v, centre)]) for k, v in known.items()}
    want = {}
    for i, text in texts:
        bundle = brute_bundle(text or "", letters)
        if not any(bundle):
            want[i] = ("und", 0.0)
            continue
        mine = brute_unit([a - b for a, b in zip(brute_unit(bundle), centre)])
        cosines = {k: sum(a * b for a, b in zip(mine, v)) for k, v in compare.items()}
        best = max(cosines, key=cosines.get)
        want[i] = (best, (1 + cosines[best]) / 2)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in
           language.identify(make(texts), make(training), keep={"doc_id": F.col("doc_id")}).collect()}
    assert {i: lang for i, (lang, _) in got.items()} == {i: lang for i, (lang, _) in want.items()}
    for i in got:
        assert got[i][1] == pytest.approx(want[i][1], abs=1e-5)
