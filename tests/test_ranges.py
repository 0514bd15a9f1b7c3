import csv
import io
import json
import random

import pytest

from tablewright.sources import load_table, read_csv, read_json
from tablewright.sources.ranges import CsvScanner, JsonScanner


def cells_of(rng):
    return rng.choice(["", "plain", 'say "hi"', "a,b", "line\nbreak", '"', '""', "\n", 'x\n"y",\n', "ünï", " lead", 'mid"quote', "5", "a;b"])


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield size
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end, bytes_a_range", [("\n", 150), ("\r\n", 211), ("\n", 1 << 20)])
def test_ranges_equal_one_task(spark, tmp_path, small_ranges, end, bytes_a_range):
    rng = random.Random(bytes_a_range)
    for name in ("a.csv", "b.csv"):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["key", "left\nright", "t"])
        for i in range(150):
            writer.writerow([f"{name}{i}", cells_of(rng), cells_of(rng) * rng.choice([1, 1, 30])])
        text = out.getvalue().replace("\n", end)
        (tmp_path / name).write_text("﻿" + text + end if name == "a.csv" else text, encoding="utf-8", newline="")
    small_ranges(bytes_a_range)
    schema = "key string, u string, t string"
    want = read_csv(spark, str(tmp_path), schema=schema, missing=[], ranges_from=1 << 40)
    got = read_csv(spark, str(tmp_path), schema=schema, missing=[], ranges_from=0)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.count() == 300


def test_many_tasks_read_one_file(spark, tmp_path, small_ranges):
    with open(tmp_path / "big.csv", "w") as f:
        f.write("id,t\n")
        for i in range(20_000):
            f.write(f'{i},"line {i}\nand ""more"" of it"\n' if i % 7 == 0 else f"{i},plain\n")
    small_ranges(1 << 16)
    read = read_csv(spark, str(tmp_path / "big.csv"), schema="id long, t string", ranges_from=1)
    assert read.rdd.getNumPartitions() >= 4
    assert read.count() == 20_000 and read.where("t LIKE 'line%it'").count() == 2858
    inferred = load_table(spark, str(tmp_path / "big.csv"), ranges_from=1)
    assert dict(inferred.dtypes) == {"id": "bigint", "t": "string"} and inferred.agg({"id": "sum"}).first()[0] == sum(range(20_000))


def test_a_cell_over_many_ranges_and_an_open_one(spark, tmp_path, small_ranges):
    long = "x\n" * 500
    (tmp_path / "t.csv").write_text(f'a,b\n1,"{long}"\n2,y\n3,"{long}{long}"\n')
    small_ranges(64)
    got = read_csv(spark, str(tmp_path / "t.csv"), schema="a long, b string", missing=[], ranges_from=0)
    assert sorted(map(tuple, got.collect())) == [(1, long), (2, "y"), (3, long + long)]
    (tmp_path / "u.csv").write_text('a,b\n1,"x"\n2,"never closed\nto the end\n')
    opened = read_csv(spark, str(tmp_path / "u.csv"), schema="a long, b string", missing=[], ranges_from=0).orderBy("a").collect()
    assert opened[0]["b"] == "x" and opened[1]["a"] == 2


def test_no_header_other_separator_and_empty_files(spark, tmp_path, small_ranges):
    (tmp_path / "t.csv").write_text('1|"a|\nb"\n\n2|5" pipe\n3|"q"x\n')
    (tmp_path / "none.csv").write_text("")
    small_ranges(8)
    read = lambda n: sorted(map(tuple, read_csv(spark, str(tmp_path), sep="|", header=False, schema="a long, b string", ranges_from=n).collect()), key=str)
    assert read(0) == read(1 << 40) and len(read(0)) == 3


@pytest.mark.parametrize("line, state, want", [
    ("a,b", 0, 0), ('a,"b', 0, 1), ('"a""', 0, 1), ('"a"', 0, 0), ('"a""b"', 0, 0), ('5" x,y"', 0, 0), ('"a"b"c,d', 0, 0), ('x,""', 0, 0), ('x,"""', 0, 1),
    ("more", 1, 1), ('end"', 1, 0), ('end",z', 1, 0), ('end","again', 1, 1), ('""', 1, 1), ('"', 1, 0), ('"tail,"open', 1, 1)])
def test_states(line, state, want):
    assert CsvScanner(",").step(state, line) == want


def json_value(rng):
    return rng.choice(["plain", 'quo"te', "br}ace{", "back\\", "\\\"}", "line\nbreak", "[x]", "", "ünï", None])


@pytest.mark.parametrize("indent, bytes_a_range", [(None, 150), (2, 211), (1, 1 << 20)])
def test_json_arrays_equal_one_task(spark, tmp_path, small_ranges, indent, bytes_a_range):
    rng = random.Random(bytes_a_range)
    for name in ("a.json", "b.json"):
        rows = [{"id": i, "t": json_value(rng), "deep": {"x": [{"y": json_value(rng)} for _ in range(rng.randint(0, 3))], "z": i}} for i in range(80)]
        (tmp_path / name).write_text(" \n" + json.dumps(rows, indent=indent, ensure_ascii=False) + "\n", encoding="utf-8")
    (tmp_path / "none.json").write_text("[]\n")
    (tmp_path / "one.json").write_text('{"id": 1000, "t": "a}", "deep": {"x": [], "z": 1}}\n')
    small_ranges(bytes_a_range)
    schema = "id long, t string, deep struct<x:array<struct<y:string>>,z:long>"
    want = [r for r in read_json(spark, str(tmp_path), schema=schema, ranges_from=1 << 40).collect()]
    got = read_json(spark, str(tmp_path), schema=schema, ranges_from=0)
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and len(want) == 161
    inferred = read_json(spark, str(tmp_path), ranges_from=0)
    assert dict(inferred.dtypes)["deep"] == "struct<x:array<struct<y:string>>,z:bigint>" and inferred.count() == 161


@pytest.mark.parametrize("piece, inside, want", [
    ('[{"a": 1', 0, (0, 2)), ('{"a": "x', 0, (1, 1)), ('still', 1, (1, 0)), ('end", "b": [1, 2]', 1, (0, 0)), ('\\" no', 1, (1, 0)), ('"a\\\\"', 0, (0, 0)), (']', 0, (0, -1))])
def test_json_states(piece, inside, want):
    assert JsonScanner().step(inside, piece) == want
