import os

import duckdb
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, score double, row string, bucket int, fp int"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text, lang, source), with further columns whose names the operators use inside."""
    def of(rows, parts=3):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), "x", 0.5, "r", 1, 2) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return of


@pytest.fixture(scope="session")
def rows_of():
    """(doc_id, text, lang, source) of a given documents table."""
    def of(sf_dir):
        path = f"{sf_dir}/documents.parquet"
        path += "/*.parquet" if os.path.isdir(path) else ""
        return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{path}' ORDER BY doc_id").fetchall()

    return of


EDGE = [
    (None, "the cat sat on the mat and the dog sat on the log"), (None, None), (1, None), (2, ""), (3, " \n\t\x0b "), (4, "a"), (4, "a"),
    (5, "ein Wort\nein Wort\nein Wort"), (6, "same text of a few words here"), (7, "same text of a few words here"),
    (8, "long " * 30_000 + "end"), (9, "ÄÖÜ ß é 漢字 🙂 x́   !!! ###"), (10, "word"), (11, "one two three"), (12, "\n\n"), (13, "x\r\ny"),
]


@pytest.fixture(scope="session")
def edge():
    return list(EDGE)
