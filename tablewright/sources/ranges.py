"""Large CSV and JSON files read by many tasks, although records may hold line breaks.

A task that starts in the middle of a file cannot tell whether it stands inside a quoted text. So each byte range is first scanned from every state in which it may
start, which gives the state at its end for each; the ranges of a file are then gone through in order, which settles the true states; and each range is cut into records from its
own. A record that reaches over ranges is put together from its parts. Ranges, lines and their order are those of Spark's text source, with ``_metadata``
naming file and start of the range, so any file system that Spark reads will do. A record is held by one task, a file never is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import materialise

RANGE = ["file", "at"]


def text_ranges(spark: SparkSession, path: str, ends_with: str) -> DataFrame:
    """The pieces of the files that ``ends_with`` ends, with file and start of the range they were read in; in order within a range."""
    return spark.read.option("lineSep", ends_with).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; contents are not read."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


class CsvScanner:
    """State after a line: 1 inside a quoted cell, 0 at the end of a record. Quotes count where a cell starts; elsewhere they are text."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        # The whole cells that a separator follows, then what is left: possessive, so a line is read once.
        self.cells = re.compile(rf'(?:(?:"(?:[^"]++|"")*+"[^{s}]*+|[^"{s}][^{s}]*+)?{s})*+')
        self.quoted = re.compile(r'"(?:[^"]++|"")*+"')
        self.closing = re.compile(rf'(?:[^"]++|"")*+"[^{s}]*+')

    def step(self, state: int, line: str) -> int:
        at = 0
        if state:
            closed = self.closing.match(line)
            if not closed:
                return 1
            at = closed.end()
            if at == len(line):
                return 0
            at += 1  # the separator
        at = self.cells.match(line, at).end()
        return int(line.startswith('"', at) and not self.quoted.match(line, at))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(file, start of the range), first row and end of each run of rows of one range."""
    files, ats = batch.column("file").to_pylist(), batch.column("at").to_pylist()
    first = 0
    for i in range(1, len(ats) + 1):
        if i == len(ats) or ats[i] != ats[first] or files[i] != files[first]:
            yield (files[first], ats[first]), first, i
            first = i


def _summaries(scanner: CsvScanner):
    """Per range: the states at its end from both starts, and whether a record that starts inside is open there if the range starts in a quoted cell."""
    def row(key, ends, left):
        return pa.RecordBatch.from_pydict({"file": [key[0]], "at": [key[1]], "end0": [ends[0]], "end1": [ends[1]], "left": [left]},
                                          pa.schema([("file", pa.string()), ("at", pa.int64()), ("end0", pa.int32()), ("end1", pa.int32()), ("left", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, left = None, [0, 1], False
        for batch in batches:
            values = batch.column("value")
            for here, first, end in _runs(batch):
                if here != key:
                    if key is not None:
                        yield row(key, ends, left)
                    key, ends, left = here, [0, 1], False
                for line in values.slice(first, end - first).drop_null().to_pylist():
                    if ends[0] == ends[1]:  # both starts have met
                        ends = [scanner.step(ends[0], line)] * 2
                    else:
                        ends = [scanner.step(e, line) for e in ends]
                    left = left or ends[1] == 0
        if key is not None:
            yield row(key, ends, left)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """True states over the ranges of a file in order: ``start``, ``open`` at the end, and ``owner``, the range in which the record open at the start began."""
    file, state, owner = None, 0, None
    for batch in batches:
        out = {"start": [], "open": [], "owner": []}
        for r in batch.to_pylist():
            if r["file"] != file:
                file, state, owner = r["file"], 0, None
            out["start"].append(state)
            out["owner"].append(owner)
            end = r["end1"] if state else r["end0"]
            if end and (not state or r["left"]):
                owner = r["at"]
            elif not end:
                owner = None
            state = end
            out["open"].append(state)
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), batch.column("at"), pa.array(out["start"], pa.int32()), pa.array(out["open"], pa.int32()), pa.array(out["owner"], pa.int64())],
            names=["file", "at", "start", "open", "owner"])


def _records(scanner: CsvScanner, header: bool, fragments: bool):
    """The whole records of each range, or the parts of records that reach over its ends (with their range, their owner, and whether they are a file's header)."""
    schema = pa.schema([("record", pa.string()), ("file", pa.string()), ("owner", pa.int64()), ("part", pa.int64()), ("is_header", pa.bool_())])

    def table(records):
        n = len(records)
        return pa.RecordBatch.from_arrays([records if isinstance(records, pa.Array) else pa.array(records, pa.string()), *(pa.nulls(n, t) for t in schema.types[1:])], schema=schema)

    def fragment(key, owner, held, is_header):
        return pa.RecordBatch.from_arrays([pa.array(["\n".join(held)]), pa.array([key[0]]), pa.array([owner], pa.int64()), pa.array([key[1]]), pa.array([is_header])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, owner, held, skip = None, 0, None, [], False
        for batch in batches:
            lines = pc.utf8_rtrim(batch.column("value"), "\r")
            quoted = pc.match_substring(lines, '"')
            for here, first, end in _runs(batch):
                if here != key:
                    if held and fragments:
                        yield fragment(key, key[1] if owner is None else owner, held, skip)
                    key, held = here, []
                    state, owner = batch.column("start")[first].as_py(), batch.column("owner")[first].as_py()
                    skip = header and here[1] == 0
                some = lines.slice(first, end - first)
                if not state and not pc.any(quoted.slice(first, end - first)).as_py():
                    some = some.filter(pc.greater(pc.binary_length(some), 0))
                    if skip and len(some):
                        some, skip = some.slice(1), False
                    if not fragments and len(some):
                        yield table(some)
                    continue
                whole = []
                for line in some.to_pylist():
                    if not held and not state and not line:
                        continue
                    held.append(line)
                    state = scanner.step(state, line) if state or '"' in line else 0
                    if not state:
                        if owner is not None:  # the end of a record of an earlier range
                            if fragments:
                                yield fragment(key, owner, held, False)
                            owner = None
                        elif skip:
                            skip = False
                        else:
                            whole.append("\n".join(held))
                        held = []
                if whole and not fragments:
                    yield table(whole)
        if held and fragments:
            yield fragment(key, key[1] if owner is None else owner, held, skip)

    return run


RECORD = "record string, file string, owner long, part long, is_header boolean"


def csv_records(spark: SparkSession, path: str, sep: str, header: bool) -> DataFrame:
    """``record``: every record of the CSV files but their headers, with ``\\n`` for the line breaks inside; blank lines are none."""
    scanner = CsvScanner(sep)
    lines = text_ranges(spark, path, "\n").withColumn("value", F.when(F.col("at") > 0, F.col("value")).otherwise(F.ltrim("value", F.lit("﻿"))))
    marked = lines.select(*RANGE, F.when(F.contains("value", F.lit('"')), F.rtrim("value", F.lit("\r"))).alias("value"))
    summaries = marked.mapInArrow(_summaries(scanner), "file string, at long, end0 int, end1 int, left boolean")
    states = materialise(summaries.repartition("file").sortWithinPartitions(*RANGE).mapInArrow(
        _settle, "file string, at long, start int, open int, owner long"), "csv-ranges")
    # One row per range: broadcast.
    whole = lines.join(F.broadcast(states), RANGE).mapInArrow(_records(scanner, header, False), RECORD).select("record")
    across = states.where("start = 1 OR open = 1")
    if across.isEmpty():
        return whole
    parts = lines.join(F.broadcast(across), RANGE).mapInArrow(_records(scanner, header, True), RECORD)
    joined = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("part", "record"))).alias("parts"), F.max("is_header").alias("is_header"))
    return whole.unionByName(joined.where("NOT is_header").select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))


class JsonScanner:
    """State after a piece that "}" ends: whether it is inside a string, and the depth of brackets before that "}"."""

    strings = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.DOTALL)
    closing = re.compile(r'(?:[^"\\]++|\\.)*+"', re.DOTALL)

    def step(self, inside: int, piece: str) -> tuple[int, int]:
        """Whether the piece ends inside a string, and by how much it changes the depth."""
        if inside:
            closed = self.closing.match(piece)
            if not closed:
                return 1, 0
            piece = piece[closed.end():]
        bare = self.strings.sub("", piece) if '"' in piece else piece
        opened = bare.find('"')
        bare = bare if opened < 0 else bare[:opened]
        return int(opened >= 0), bare.count("{") + bare.count("[") - bare.count("]")


_JSON_SUMMARY = pa.schema([("file", pa.string()), ("at", pa.int64()), ("array", pa.bool_()),
                           *((f"{c}{s}", pa.int64()) for s in (0, 1) for c in ("end", "depth", "least"))])


def _json_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, from outside and inside a string: the state at its end, the change of depth, and the least depth after a "}"; of a file's first range, whether it opens an array."""
    scanner = JsonScanner()

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(_JSON_SUMMARY.names, [*key, array, *ends[0], *ends[1]]))], schema=_JSON_SUMMARY)

    key, array, ends = None, None, None
    for batch in batches:
        values = batch.column("value")
        for here, first, end in _runs(batch):
            if here != key:
                if key is not None:
                    yield row()
                key, array, ends = here, None, [[0, 0, 0], [1, 0, 0]]
            for piece in values.slice(first, end - first).to_pylist():
                if array is None and here[1] == 0:
                    array = piece.lstrip().startswith("[")
                for e in ends:
                    e[0], more = scanner.step(e[0], piece)
                    e[1] += more - (not e[0])
                    if not e[0]:
                        e[2] = min(e[2], e[1])
    if key is not None:
        yield row()


def _json_settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """True states over the ranges of a file in order: in a string, depth, the depth between records, ``open`` at the end, ``owner`` as for CSV."""
    file, inside, depth, base, owner = None, 0, 0, 0, None
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["file"] != file:
                file, inside, depth, base, owner = r["file"], 0, 0, int(bool(r["array"])), None
            row = [r["file"], r["at"], inside, depth, base, owner]
            was_open = depth > base or inside
            left = not was_open or depth + r[f"least{inside}"] <= base
            depth, inside = depth + r[f"depth{inside}"], r[f"end{inside}"]
            is_open = depth > base or inside
            owner = None if not is_open else r["at"] if left else owner
            rows.append([*row, bool(was_open), bool(is_open)])
        names = ["file", "at", "inside", "depth", "base", "owner", "start", "open"]
        kinds = [pa.string(), *[pa.int64()] * 5, pa.bool_(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _json_records(fragments: bool):
    schema = pa.schema([("record", pa.string()), ("file", pa.string()), ("owner", pa.int64()), ("part", pa.int64())])
    scanner = JsonScanner()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, inside, depth, base, owner = None, [], 0, 0, 0, None

        def fragment():
            return pa.RecordBatch.from_pylist([{"record": "".join(held), "file": key[0], "owner": key[1] if owner is None else owner, "part": key[1]}], schema=schema)

        for batch in batches:
            values = batch.column("value")
            for here, first, end in _runs(batch):
                if here != key:
                    if held and fragments:
                        yield fragment()
                    key, held = here, []
                    inside, depth, base, owner = (batch.column(c)[first].as_py() for c in ("inside", "depth", "base", "owner"))
                whole = []
                for piece in values.slice(first, end - first).to_pylist():
                    if not held and owner is None:
                        piece = piece.lstrip(" \t\r\n,")
                        if not depth and base and piece.startswith("["):
                            piece, depth = piece[1:].lstrip(), 1
                    inside, more = scanner.step(inside, piece)
                    depth += more
                    if not inside and depth <= base:  # what stands behind the last record
                        held = []
                        continue
                    held.append(piece + "}")
                    depth -= not inside
                    if not inside and depth == base:
                        if owner is None:
                            whole.append("".join(held))
                        elif fragments:
                            yield fragment()
                        held, owner = [], None
                if whole and not fragments:
                    yield pa.RecordBatch.from_arrays([pa.array(whole, pa.string()), *(pa.nulls(len(whole), t) for t in schema.types[1:])], schema=schema)
        if held and fragments:
            yield fragment()

    return run


def json_array_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the text of every object of files that hold one array of objects, or objects one after the other, however they are laid out."""
    pieces = text_ranges(spark, path, "}")
    states = materialise(
        pieces.mapInArrow(_json_summaries, "file string, at long, array boolean, end0 long, depth0 long, least0 long, end1 long, depth1 long, least1 long")
        .repartition("file").sortWithinPartitions(*RANGE)
        .mapInArrow(_json_settle, "file string, at long, inside long, depth long, base long, owner long, start boolean, open boolean"), "json-ranges")
    layout = "record string, file string, owner long, part long"
    whole = pieces.join(F.broadcast(states), RANGE).mapInArrow(_json_records(False), layout).select("record")
    across = states.where("start OR open")
    if across.isEmpty():
        return whole
    parts = pieces.join(F.broadcast(across), RANGE).mapInArrow(_json_records(True), layout)
    joined = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("part", "record"))).alias("parts"))
    return whole.unionByName(joined.select(F.array_join(F.transform("parts", lambda p: p["record"]), "").alias("record")))
