import math
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tablewright.functions import numeric as num
from tablewright.functions import text as txt
from tablewright.functions.fuzzy import canonicalise, weighted_score


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, expression, kind="string"):
    rows = one_column(spark, values, kind).select("i", expression.alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


def test_normalise_text_strips_what_python_strips(spark):
    values = ["  Male ", "\tFEMALE\n", " x　", "\x1cA b\x1f", "", None]
    want = [None if v is None else v.lower().strip() for v in values]
    assert apply(spark, values, txt.normalise_text(F.col("v"))) == want


def test_null_tokens(spark):
    values = ["nan", "none", "null", "", "nil", None]
    assert apply(spark, values, txt.null_tokens(F.col("v"))) == [None, None, None, None, "nil", None]
    assert apply(spark, ["none"], txt.null_tokens(F.col("v"), ["nan"])) == ["none"]


def test_first_integer(spark):
    values = ["Age: 31 or 40", "x", "007", "1" * 60, None, "0", "000"]
    got = apply(spark, values, txt.first_integer(F.col("v")))
    assert got[:3] == [31, None, 7] and got[3] == 10**38 - 1 and got[4:] == [None, 0, 0]


def test_age_bucket(spark):
    values = ["16-25", "15", "16", "25 years", "26", "39", "40", "64", "65", "9" * 50, "abc", None, "16 - 25", "-30"]
    want = ["16-25", None, "16-25", "16-25", "26-39", "26-39", "40-64", "40-64", "65+", "65+", None, None, "16-25",
            "26-39"]
    assert apply(spark, values, txt.age_bucket(F.col("v"), ["16-25", "26-39", "40-64", "65+"])) == want


def test_age_bucket_label_outside_the_valid_list_is_missing(spark):
    assert apply(spark, ["30", "70"], txt.age_bucket(F.col("v"), ["65+"])) == [None, "65+"]


def test_map_values_unmapped_and_missing(spark):
    mapped = txt.map_values(F.col("v"), {"a": 1, "b": 2})
    assert apply(spark, ["a", "b", "c", None], mapped) == [1.0, 2.0, 0.0, 0.0]
    assert apply(spark, ["c"], txt.map_values(F.col("v"), {"a": 1}, unmapped=-1)) == [-1.0]


def test_category_text(spark):
    assert apply(spark, [1, None], txt.category_text(F.col("v")), "int") == ["1", "nan"]


def test_coerce_number(spark):
    assert apply(spark, ["1", " 3 ", "abc", "NaN", None, "1e3"], num.coerce_number(F.col("v"))) == [
        1.0, 3.0, None, None, None, 1000.0]


def test_out_of_range_bounds_are_valid_and_missing_is_never_out(spark):
    values = [0.0, 1.0, -0.1, 1.1, None]
    assert apply(spark, values, num.out_of_range(F.col("v"), 0, 1), "double") == [False, False, True, True, False]
    assert apply(spark, values, num.out_of_range(F.col("v"), 0, None), "double") == [False, False, True, False, False]
    assert apply(spark, values, num.out_of_range(F.col("v"), None, None), "double") == [False] * 5


def test_clip_keeps_missing(spark):
    assert apply(spark, [-5.0, 0.5, 9.0, None], num.clip(F.col("v"), 0.0, 1.0), "double") == [0.0, 0.5, 1.0, None]


def test_log_positive(spark):
    got = apply(spark, [-1.0, 0.0, 1.0, None], num.log_positive(F.col("v")), "double")
    assert got[0] == -1.0 and got[1] == 0.0 and got[2] == pytest.approx(math.log(2)) and got[3] is None


@pytest.mark.parametrize("lam", [-1.0, 0.0, 0.5, 1.0, 2.0, 2.5])
def test_yeo_johnson_formula(spark, lam):
    def want(y):
        if y >= 0:
            return math.log(y + 1) if lam == 0 else ((y + 1) ** lam - 1) / lam
        return -math.log(1 - y) if lam == 2 else -((1 - y) ** (2 - lam) - 1) / (2 - lam)

    values = [-3.0, -0.5, 0.0, 0.5, 4.0]
    assert apply(spark, values, num.yeo_johnson(F.col("v"), lam), "double") == pytest.approx([want(v) for v in values])


def test_bin_index(spark):
    got = apply(spark, [-1.0, 1.0, 1.5, 2.0, 99.0, None], num.bin_index(F.col("v"), [1.0, 2.0]), "double")
    assert got == [0.0, 1.0, 1.0, 2.0, 2.0, None]


def test_weighted_score_follows_the_parts_it_is_made_of():
    assert weighted_score("sedan", "sedan") == 100
    assert weighted_score("sedn", "sedan") == round(100 * SequenceMatcher(None, "sedn", "sedan").ratio()) == 89
    # Word order does not matter, up to the weight of a token score.
    assert weighted_score("school high", "high school") == 95
    # An abbreviation is a full partial match at the weight of a partial score.
    assert weighted_score("uni", "university") == 90
    assert weighted_score("u", "university") == 60
    assert weighted_score("", "university") == 0 and weighted_score("--", "university") == 0
    assert weighted_score("High-School!", "high school") == 100


def test_canonicalise_weighted(spark):
    golden = ["none", "high school", "university"]
    values = ["university", "universit", "uni", "school high", "xyz", None, "highschool"]
    assert apply(spark, values, canonicalise(F.col("v"), golden)) == [
        "university", "university", "university", "high school", None, None, "high school"]


def test_canonicalise_ties_go_to_the_first(spark):
    assert apply(spark, ["m"], canonicalise(F.col("v"), ["male", "female"])) == ["male"]
    assert apply(spark, ["m"], canonicalise(F.col("v"), ["female", "male"])) == ["female"]


def test_canonicalise_edit_threshold(spark):
    golden = ["sedan", "sports car", "suv", "hatchback"]
    values = ["sedan", "sedn", "hatchbck", "sports  car", None]
    assert apply(spark, values, canonicalise(F.col("v"), golden, 90, "edit")) == [
        "sedan", None, "hatchback", "sports car", None]
    assert apply(spark, ["sedn"], canonicalise(F.col("v"), golden, 89, "edit")) == ["sedan"]


def test_canonicalise_all_golden_or_missing(spark):
    assert apply(spark, ["a", None, "a"], canonicalise(F.col("v"), ["a"])) == ["a", None, "a"]


def test_unknown_scorer(spark):
    with pytest.raises(ValueError):
        canonicalise(F.col("v"), ["a"], scorer="other")
