"""Readers for CSV, JSON and Parquet with the missing-value rules of a data frame loader."""

from __future__ import annotations

import os
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.sources.ranges import csv_records, json_array_records, largest_file

# Texts that a CSV cell may hold for "missing".
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def nan_as_null(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere: turn the NaN of float columns into NULL."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floats:
        return df
    return df.select(*[F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats
                       else F.col(f"`{c}`") for c in df.columns])


# Kinds of a text cell as bits; a column's cells are combined with a bitwise or.
_INTEGER, _NUMBER, _BOOLEAN, _TEXT = 1, 2, 4, 8


_SHORT_INTEGER, _LONG_INTEGER = r"^\s*[+-]?\d{1,18}\s*$", r"^\s*[+-]?\d{19}\s*$"
_NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def _cell_kind(c: Column) -> Column:
    """Kind of one cell, cheapest test first; NULL for a missing cell.

    Numbers are told by a pattern: a cast that fails costs far more, and it takes "1d" for a number.
    """
    return (F.when(c.isNull(), None).when(c.rlike(_SHORT_INTEGER), _INTEGER)
            .when(c.rlike(_LONG_INTEGER) & c.try_cast("bigint").isNotNull(), _INTEGER)
            .when(c.rlike(_NUMBER_TEXT), _NUMBER).when(F.lower(c).isin("true", "false"), _BOOLEAN).otherwise(_TEXT))


def _column_type(kinds: int | None) -> str:
    if kinds == _INTEGER:
        return "bigint"
    if kinds is None or kinds in (_NUMBER, _INTEGER | _NUMBER):
        return "double"
    return "boolean" if kinds == _BOOLEAN else "string"


def _infer(raw: DataFrame) -> DataFrame:
    """Cast text columns to bigint, double or boolean where every present value allows it.

    One aggregate over the whole file decides for all columns.
    """
    if not raw.columns:
        return raw
    # One aggregate with one value per column. The test runs over an array of the cells, so that it is compiled
    # once and stays small, whatever the width.
    cells = raw.select(F.transform(F.array(*[F.col(f"`{c}`") for c in raw.columns]), _cell_kind).alias("kinds"))
    found = cells.agg(*[F.bit_or(F.get("kinds", F.lit(i))).alias(f"k{i}") for i in range(len(raw.columns))]).first()
    kinds = {i: found[i] for i in range(len(raw.columns)) if found[i] is not None}
    types = {c: _column_type(kinds[i]) if i in kinds else "double" for i, c in enumerate(raw.columns)}
    return raw.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in types.items() if t != "string"})


#: Files from this size on are read in ranges by many tasks.
RANGES_FROM = 32 << 20


def read_csv(spark: SparkSession, path: str, sep: str = ",", header: bool = True, schema=None,
             missing=MISSING_TEXT, multiline: bool = True, ranges_from: int = RANGES_FROM, **options) -> DataFrame:
    """CSV with any separator. Texts in ``missing`` become NULL before the types are inferred.

    Quoted cells may hold line breaks. Files of ``ranges_from`` bytes or more are split between tasks all the same (``csv_records``), unless reader
    ``options`` are given or the separator has several characters: then one task reads one file. Give ``multiline=False`` for files known to have one row per
    line, which saves the scan for quotes, and a ``schema`` for large files: inference reads everything once.
    """
    reader = spark.read.options(sep=sep, header=header, quote='"', escape='"', multiLine=multiline, **options)
    names = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in names]))
    raw = reader.csv(path)
    if multiline and not options and len(sep) == 1 and raw.columns and largest_file(spark, path) >= ranges_from:
        layout = ", ".join(f"c{i} string" for i in range(len(raw.columns)))
        cells = F.from_csv("record", layout, {"sep": sep, "quote": '"', "escape": '"'})
        raw = csv_records(spark, path, sep, header).select(cells.alias("r")).select(
            *[F.col(f"r.c{i}").alias(c) for i, c in enumerate(raw.columns)])
    raw = raw.select(*[F.when(~F.col(f"`{c}`").isin(list(missing)), F.col(f"`{c}`")).alias(c)
                       for c in raw.columns])
    if names is not None:
        return nan_as_null(raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
                                        for f in names]))
    return nan_as_null(_infer(raw))


def read_json(spark: SparkSession, path: str, lines: bool = False, schema=None, ranges_from: int = RANGES_FROM, **options) -> DataFrame:
    """JSON records: an array of objects per file, or one record per line (``lines=True``).

    Files of arrays from ``ranges_from`` bytes on are split between tasks (``json_array_records``); with reader ``options``, one task reads one file.
    """
    if lines or options or largest_file(spark, path) < ranges_from:
        reader = spark.read.options(multiLine=not lines, **options)
        return nan_as_null((reader if schema is None else reader.schema(schema)).json(path))
    records = json_array_records(spark, path)
    reader = spark._jsparkSession.read()
    if schema is not None:
        ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        reader = reader.schema(ddl)
    # A table of texts is what the reader takes besides paths; from Python only its JVM side is within reach.
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return nan_as_null(DataFrame(reader.json(texts), spark))


def read_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return nan_as_null(spark.read.options(**options).parquet(path))


_READERS = {".csv": read_csv, ".json": read_json, ".parquet": read_parquet}


def load_table(spark: SparkSession, path: str, format: str | None = None, **options) -> DataFrame:
    """Pick the reader by the lower-cased suffix of the path, or by ``format``.

    A missing path raises FileNotFoundError, an unknown suffix ValueError.
    """
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    kind = f".{format}" if format else suffix
    if kind not in _READERS:
        raise ValueError(f"unsupported table format {kind!r} of {path!r}")
    if format and suffix and suffix != kind:
        warnings.warn(f"{path!r} may not be a {format} file", stacklevel=2)
    try:
        return _READERS[kind](spark, path, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise


def table_shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)
