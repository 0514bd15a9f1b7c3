import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablewright.llm import rules
from tablewright.llm.queries import op4_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("few", [64, 0])
def test_base_counts(make, edge, rows_of, sf_dir, few, monkeypatch):
    monkeypatch.setattr(rules, "FEW", few)
    rows = [r[:2] for r in rows_of(sf_dir)] + edge + [(500, "a b c a b c a b"), (501, "a a a a"), (502, "a b\na b\n \nab c")]
    got = rules.apply_rules(make(rows), rules.DecisionList()).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    want = []
    for doc, text in rows:
        b = brute(text)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want.append((doc, *b, failed, not failed))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_learnt_list_separates(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    table = op4_quality_rules(spark, sf).join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count()
    n = {(r["quality"], r["kept"]): r["count"] for r in table.collect()}
    assert n.get((0, True), 0) <= 0.1 * (n.get((0, True), 0) + n[0, False])
    assert n.get((1, False), 0) <= 0.01 * n[1, True]


def test_rules_are_ordered_thresholds(make):
    rows = [(i, "good plain words " * (20 + i % 7) if i % 3 else "#### **** " * (30 + i % 5)) for i in range(300)]
    labels = make(rows).select("doc_id", F.when(F.col("text").startswith("#"), 0).otherwise(1).alias("quality"))
    learnt = rules.learn_rules(rules.labelled_statistics(make(rows), labels, "doc_id", "text", "quality", 1000))
    assert learnt.rules and all(c.statistic in rules.STATISTICS for r in learnt.rules for c in r.conditions)
    got = rules.with_statistics(make(rows), "text", {"doc_id": F.col("doc_id")}).withColumn("kept", learnt.kept()).collect()
    assert all(r["kept"] == (r["doc_id"] % 3 != 0) for r in got)


def test_without_labels_or_rows(make):
    none = make([]).select("doc_id", F.lit(0).alias("quality"))
    one_class = make([(1, "x y z " * 40)]).select("doc_id", F.lit(1).alias("quality"))
    for labels in (none, one_class):
        got = rules.quality_rules(make([(1, " ".join(f"w{i}" for i in range(60))), (2, None)]), labels).collect()
        assert {r["doc_id"]: r["kept"] for r in got} == {1: True, 2: False}
    assert rules.quality_rules(make([]), none).count() == 0
