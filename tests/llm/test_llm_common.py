from pyspark.sql import functions as F

from tablewright.llm.common import arrow_batches, sampled


def test_samples_of_any_number_of_rows(spark):
    """The share is right, and never nothing where the table has far more rows than the sample."""
    n = spark.range(400_000).where(sampled(F.col("id"), 20_000, 400_000)).count()
    assert abs(n - 20_000) < 1000
    # As many rows of a table of 10**12 as fall below its threshold: one in fifty million.
    few = spark.range(400_000).select(sampled(F.col("id"), 20_000, 10 ** 12).alias("c"), F.xxhash64("id", F.lit("sample")).alias("h"))
    assert few.where("c").count() == few.where(F.col("h") < -(1 << 63) + (20_000 << 64) // 10 ** 12).count()
    assert spark.range(1).select(F.lit(-(1 << 63)) < F.lit(-(1 << 63) + (20_000 << 64) // 10 ** 12)).first()[0]


def test_batch_size_is_restored(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with arrow_batches(spark, 7):
        assert spark.conf.get(name) == "7"
    assert spark.conf.get(name) == before
