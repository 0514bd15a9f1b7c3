import numpy as np
from pyspark.sql import functions as F

from tablewright.llm import bytecnn
from tablewright.llm.queries import op8_byte_cnn


def area(scores, labels):
    order = np.argsort(np.argsort(scores))
    good, bad = (labels == 1).sum(), (labels == 0).sum()
    return (order[labels == 1].sum() - good * (good - 1) / 2) / (good * bad)


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = op8_byte_cnn(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    labels = held["quality"].to_numpy()
    assert area(held["score"].to_numpy(), labels) >= 0.97
    assert (held["predicted"].to_numpy()[labels == 1] == 1).mean() >= 0.99


def small_model():
    rng = np.random.default_rng(0)
    samples = [(i % 2, bytecnn.training_chunks((b"good words here " if i % 2 else b"## $$ %% ") * int(rng.integers(3, 80)), 4)) for i in range(80)]
    return samples, bytecnn.train(samples, epochs=6, batch=8)


def test_training_is_deterministic_and_learns():
    samples, model = small_model()
    again = bytecnn.train(samples, epochs=6, batch=8)
    texts = [b"good words here " * 9, b"## $$ %% " * 20]
    assert (model.scores(texts) == again.scores(texts)).all()
    assert model.scores(texts)[0] > 0.9 and model.scores(texts)[1] < 0.1


def test_whole_text_counts_and_batches_do_not():
    _, model = small_model()
    rng = np.random.default_rng(1)
    texts = [rng.integers(32, 127, n).astype(np.uint8).tobytes() for n in (0, 1, 63, 64, 65, 511, 512, 513, 9000, 20_000, 1_200_000)]
    together = model.scores(texts)
    assert np.allclose(together, [model.scores([t])[0] for t in texts], atol=1e-9)
    long = b"good words here " * 4000
    assert model.features([long])[0].tolist() != model.features([long + b"## $$ %%"])[0].tolist()  # the last bytes are read


def test_responses_by_definition():
    _, model = small_model()
    text = bytes(np.random.default_rng(2).integers(0, 256, 1500).astype(np.uint8))
    blocks = -(-len(text) // bytecnn.BLOCK)
    data = text.ljust(blocks * bytecnn.BLOCK + bytecnn.WIDTH, b"\0")
    one = np.array([sum(model.table[w][data[p + w]] for w in range(bytecnn.WIDTH)) for p in range(blocks * bytecnn.BLOCK)])
    by_block = one.reshape(blocks, bytecnn.BLOCK, -1).max(axis=1)
    starts = bytecnn._starts(blocks)
    pooled = np.array([by_block[s:s + bytecnn.CHUNK].max(axis=0) for s in starts])
    assert set(b for s in starts for b in range(s, s + bytecnn.CHUNK)) >= set(range(blocks))  # chunks cover the text
    assert np.allclose(model.features([text])[0], np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)]), atol=1e-4)


def test_edges(make, edge):
    labels = make([(i, "x") for i in range(14)]).select("doc_id", F.when(F.col("doc_id") == 3, None).otherwise(F.col("doc_id") % 2).cast("int").alias("quality"))
    got = bytecnn.classify_quality(make(edge), labels, epochs=2).collect()
    assert len(got) == len(edge) and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert by[6] == by[7] and by[1] == by[2] and len(by[4]) == 1
    none = labels.where("false")
    assert {r["score"] for r in bytecnn.classify_quality(make(edge), none).collect()} == {0.5}
    assert bytecnn.classify_quality(make([]), none).count() == 0
