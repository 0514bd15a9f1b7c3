import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.session import materialise

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"


def brute_targets(size, weights=(5, 2, 1), cap=3):
    """Target of each source: shares by weight, what is over ``cap`` times a source's size shared again."""
    names = sorted(size.index)
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    stopped = set()
    while True:
        rest = size.sum() - sum(cap * size[n] for n in stopped)
        left = sum(weight[n] for n in names if n not in stopped)
        over = {n for n in names if n not in stopped and rest * weight[n] / left > cap * size[n]}
        if not over:
            return {n: cap * size[n] if n in stopped else rest * weight[n] / left for n in names}
        stopped |= over


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, the documents first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), "test-stage")
        found.append((name, docs))
    return dict((name, df.toPandas()) for name, df in found)


def test_order_and_columns(stages):
    assert list(stages) == ["documents", "quality", "lines", "near_duplicates", "mixing", "packing"]
    for name in list(stages)[1:-1]:
        assert list(stages[name].columns) == list(corpus_pipeline.COLUMNS)


def test_quality_keeps_clean_documents(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    kept = set(stages["quality"]["doc_id"])
    good, bad = labels[labels == 1].index, labels[labels == 0].index
    assert sum(i in kept for i in good) >= 0.98 * len(good) and sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_lines(stages):
    before, after = stages["quality"], stages["lines"].set_index("doc_id")["text"]
    lower = {c: c + 32 for c in range(65, 91)}
    keys = [[x.strip(SPACE).translate(lower) for x in t.split("\n")] for t in before["text"]]
    found = {}
    for ks in keys:
        for k in set(ks):
            found[k] = found.get(k, 0) + 1
    for i, t, ks in zip(before["doc_id"], before["text"], keys):
        assert after[i] == "\n".join(x for x, k in zip(t.split("\n"), ks) if not k or found[k] < 10)
    assert (stages["lines"]["n_chars"] == stages["lines"]["text"].str.len()).all()


def test_near_duplicates(stages):
    from test_llm_simhash import brute_fingerprint, groups
    before = stages["lines"]
    ids = before["doc_id"].tolist()
    fps = [brute_fingerprint(t) for t in before["text"]]
    assert sorted(stages["near_duplicates"]["doc_id"]) == sorted(set(groups(fps, ids, 2)))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_rows_of_one_id_are_judged_apart(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdef"}
    rows = [(1, texts["a"], "en"), (2, texts["a"], "en"), (2, texts["b"], "en"), (3, texts["c"], "en"), (3, texts["d"], "en"),
            (None, texts["e"], "en"), (None, texts["e"], "de"), (None, texts["c"], "en"), (4, texts["f"], "fr"), (4, texts["f"], "de"), (4, texts["f"], None),
            (5, None, "en"), (6, "", "en"), (None, None, "en")]
    got = corpus_pipeline.near_duplicates(spark, documents(spark, rows).repartition(5), SF).collect()
    assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in got), key=str) == sorted([
        (1, texts["a"], "en"), (2, texts["b"], "en"), (3, texts["c"], "en"), (3, texts["d"], "en"), (None, texts["e"], "de"), (4, texts["f"], None),
        (5, None, "en")], key=str)


def test_mixing(stages):
    before, after = stages["near_duplicates"], stages["mixing"]
    copies = after.groupby("doc_id").size()
    assert copies.max() <= 3 and set(after["doc_id"]) <= set(before["doc_id"])
    sizes = before["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    source = sizes.groupby(before["source"]).sum()
    taken = after["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))).groupby(after["source"]).sum()
    targets = brute_targets(source)
    for name, target in targets.items():
        assert abs(taken.get(name, 0) - target) <= 60, name  # less than any document that is left


def test_packing(stages):
    before, packed = stages["mixing"], stages["packing"]
    whole = packed.groupby(["doc_id", "piece"]).size().groupby("doc_id").first()
    assert (whole == before.groupby("doc_id").size()).all()
    fill = packed.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 2048 and len(fill) <= packed["length"].sum() / 2048 * 1.01 + 1


def test_empty_corpus(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").where(F.lit(False)).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
