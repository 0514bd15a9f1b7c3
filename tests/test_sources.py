import json
import warnings

import pytest

from tablewright.sources import load_table, read_csv, write_table
from tablewright.sources.reader import table_shape


def test_missing_path_and_unknown_suffix(spark, tmp_path):
    for suffix in ("csv", "json", "parquet"):
        with pytest.raises(FileNotFoundError):
            load_table(spark, str(tmp_path / f"nothing.{suffix}"))
    with pytest.raises(ValueError):
        load_table(spark, str(tmp_path / "table.xyz"))


def test_csv_infers_after_nulling_tokens(spark, tmp_path):
    path = tmp_path / "T.CSV"
    path.write_text("i,d,b,t,e,none\n1,1.5,True,a,,none\nNA,nan,False,N/A,,x\n3,2,,b,NULL,null\n")
    df = load_table(spark, str(path))
    assert dict(df.dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "t": "string", "e": "double",
                               "none": "string"}
    assert [tuple(r) for r in df.collect()] == [
        (1, 1.5, True, "a", None, "none"), (None, None, False, None, None, "x"), (3, 2.0, None, "b", None, None)]


def test_csv_separator_header_and_schema(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("1|x|NA\n2|y|4.5\n")
    df = read_csv(spark, str(path), sep="|", header=False, schema="a int, b string, c double")
    assert [tuple(r) for r in df.collect()] == [(1, "x", None), (2, "y", 4.5)]


def test_csv_quoted_cells_survive_a_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi", you'), (2, "plain"), (3, None)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    path = write_table(df, str(tmp_path / "out.csv"), "csv")
    assert sorted(tuple(r) for r in load_table(spark, path).collect()) == rows


def test_json_array_and_lines(spark, tmp_path):
    records = [{"a": 1, "b": "x"}, {"a": None, "b": "y"}]
    (tmp_path / "array.json").write_text(json.dumps(records))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records))
    want = [(1, "x"), (None, "y")]
    assert [tuple(r) for r in load_table(spark, str(tmp_path / "array.json")).select("a", "b").collect()] == want
    lines = load_table(spark, str(tmp_path / "lines.json"), lines=True)
    assert [tuple(r) for r in lines.select("a", "b").collect()] == want


def test_parquet_nan_becomes_null(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    path = write_table(df, str(tmp_path / "x.parquet"))
    assert load_table(spark, path).filter("x IS NULL").count() == 2


def test_format_overrides_suffix_with_a_warning(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("a\n1\n")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert load_table(spark, str(path), format="csv").count() == 1
    assert any("may not be" in str(w.message) for w in caught)


def test_shape_and_sink_errors(spark, tmp_path):
    df = spark.range(5)
    assert table_shape(df) == (5, 1)
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "x"), "xlsx")
