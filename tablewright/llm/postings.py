"""Benchmark decontamination with a distributed positional inverted index.

1. ``build_index`` cuts the training table into segments of about ``segment_words`` words, each made by one task from the rows it reads.
   A segment numbers its words in a row, one number left out between documents, and stores for each term the list of its places (as differences), and where
   each document starts. The index is a table in the shared folder, one row per segment and term: nothing is shuffled to build it.
2. A search takes test items in blocks of at most ``block_words`` words. It reads the postings of the block's own terms and brings those of a segment together.
3. ``phrases``: a window of consecutive item words starts from the places of its rarest term in the segment, shifted by the term's offset in the window, and
   intersects them with the shifted lists of its other terms, rarest first. What is left are exact matches.
   ``near_places``: minimal intervals that hold all terms of an item, looked for around the rarest term alone.

Words are the runs of letters and digits of ASCII, A-Z lower-cased, and of all other code points.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablewright.llm.common import arrow_batches, text_batches
from tablewright.session import materialise

#: ASCII other than letters and digits separates words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SLICE = 1 << 22  # bytes of a text that are cut into words at once
CHUNK = 1 << 20  # candidate places that are checked at once


def item_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def word_numbers(text: bytes | None, numbers: defaultdict) -> np.ndarray:
    """The words of a whole text as numbers; a long text is cut into words slice by slice."""
    text = (text or b"").translate(FOLD)
    parts, at = [], 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        found = text[at:end].split()
        parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def _segment(segment: int, ids: list, texts: list[np.ndarray], terms: list[bytes], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The documents' row of a segment, and one row per term."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([segment]), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.array([starts.astype(np.int32)]),
         pa.array([lengths.astype(np.int32)]), pa.array([ids], schema.field("ids").type)], schema=schema)
    words = np.concatenate(texts)
    if not len(words):
        return
    place = np.arange(len(words), dtype=np.int32) + np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    order = np.argsort(words, kind="stable")
    sizes = np.bincount(words, minlength=len(terms))
    first = np.cumsum(sizes) - sizes
    gaps = np.diff(place[order], prepend=np.int32(0)).astype("<i4")
    gaps[first] = place[order][first]
    offsets = np.append(0, np.cumsum(sizes * 4)).astype("<i4")
    postings = pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer(offsets), pa.py_buffer(gaps)])
    n, kinds = len(terms), schema.types
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, segment)), pa.array(terms, pa.binary()).cast(pa.string()), postings, *(pa.nulls(n, t) for t in kinds[3:])], schema=schema)


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = 1 << 20) -> DataFrame:
    """The index of all rows of ``df``, written to the shared folder.

    Rows with ``term``: ``segment`` and ``postings`` (little-endian 32-bit differences). One row a segment without: ``ids``, ``starts`` and ``lengths``
    of its documents. A text longer than a segment is one segment; it has to have fewer than 2**29 words. NULL and empty texts have no words and are indexed as such; rows are
    told apart by segment and place, so repeated and NULL ids are kept. An empty table gives an empty index; other columns do not matter.
    """
    id_type = df.schema[id_col].dataType
    layout = f"segment long, term string, postings binary, starts array<int>, lengths array<int>, ids array<{id_type.simpleString()}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        schema, ids, texts, size, numbers = None, [], [], 0, None

        for batch, raw in text_batches(batches, "text"):
            kind = batch.schema.field("id").type
            schema = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("postings", pa.binary()), ("starts", pa.list_(pa.int32())),
                                ("lengths", pa.list_(pa.int32())), ("ids", pa.list_(kind))])
            for i, (doc, text) in enumerate(zip(batch.column("id").to_pylist(), raw)):
                numbers = defaultdict(count().__next__) if numbers is None else numbers
                ids.append(doc)
                texts.append(word_numbers(text, numbers))
                size += len(texts[-1]) + 1
                if size >= segment_words:
                    yield from _segment(segment, ids, texts, list(numbers), schema)
                    segment, ids, texts, size, numbers = segment + 1, [], [], 0, None
        if ids:
            yield from _segment(segment, ids, texts, list(numbers), schema)

    with arrow_batches(df.sparkSession, 1000):
        return materialise(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, layout), "postings")


@dataclass
class Block:
    """Test items: their ids, the numbers of their words, and the terms behind the numbers."""

    ids: list
    words: list[np.ndarray]
    terms: list[bytes]

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each window length: the distinct windows, and pairs (window, item). An item of fewer than ``size`` words is one window."""
        by_length = defaultdict(list)
        for item, words in enumerate(self.words):
            if n := min(size, len(words)):
                rows = np.lib.stride_tricks.sliding_window_view(words, n)
                by_length[n].append((rows, np.full(len(rows), item)))
        for found in by_length.values():
            rows, back = np.unique(np.concatenate([r for r, _ in found]), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([back.reshape(-1), np.concatenate([i for _, i in found])], axis=1), axis=0)
            yield rows, pairs[:, 0], pairs[:, 1]


def blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[Block]:
    """The items with words, in blocks: only one is held at a time."""
    ids, words, numbers, size = [], [], defaultdict(count().__next__), 0
    for item, text in items.select(F.col(id_col), F.col(text_col).cast("string")).toLocalIterator():
        found = word_numbers(None if text is None else text.encode(), numbers)
        if len(found):
            ids.append(item)
            words.append(found)
            size += len(found)
        if size >= block_words:
            yield Block(ids, words, list(numbers))
            ids, words, numbers, size = [], [], defaultdict(count().__next__), 0
    if ids:
        yield Block(ids, words, list(numbers))


class Segment:
    """The postings of a block's terms in one segment: ``keys`` are number of the term * ``span`` + place, ascending."""

    def __init__(self, table: pa.Table, terms: pa.Array, margin: int):
        docs = table.filter(pc.is_null(table["term"]))
        self.starts, self.lengths = (docs[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("starts", "lengths"))
        lists = table.filter(pc.is_valid(table["term"]))
        number = pc.index_in(lists["term"].combine_chunks(), value_set=terms).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(number)
        raw = lists["postings"].take(pa.array(order)).to_pylist()
        sizes = np.array([len(r) // 4 for r in raw], np.int64)
        gaps = np.frombuffer(b"".join(raw), "<i4").astype(np.int64)
        total, first = np.cumsum(gaps), np.cumsum(sizes) - sizes
        self.places = total - np.repeat(total[first] - gaps[first], sizes)
        self.span = int(self.starts[-1] + self.lengths[-1]) + margin + 1
        self.keys = np.repeat(number[order], sizes) * self.span + self.places
        self.sizes, self.first = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        self.sizes[number[order]], self.first[number[order]] = sizes, first

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, "right") - 1

    def expand(self, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, place) for all places of each row's term, about ``CHUNK`` at a time."""
        ends = np.cumsum(self.sizes[terms])
        at = 0
        while at < len(terms):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
            some = np.arange(at, to)
            sizes = self.sizes[terms[some]]
            row = np.repeat(some, sizes)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield row, self.places[self.first[terms[row]] + inside]
            at = to

    def has(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        wanted = terms.astype(np.int64) * self.span + places  # numbers of terms are 32-bit, keys are not
        at = np.searchsorted(self.keys, wanted)
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == wanted)

    def phrases(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of its first word) of all occurrences of windows of one length."""
        sizes = self.sizes[windows]
        live = np.flatnonzero((sizes > 0).all(axis=1))
        rare = np.argsort(sizes[live], axis=1, kind="stable")
        found = []
        for row, place in self.expand(windows[live, rare[:, 0]]):
            start = place - rare[row, 0]
            keep = start >= 0
            row, start = row[keep], start[keep]
            for k in range(1, windows.shape[1]):
                offset = rare[row, k]
                keep = self.has(windows[live[row], offset], start + offset)
                row, start = row[keep], start[keep]
            found.append((live[row], start))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def near_places(self, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the minimal intervals of one document, of at most ``within`` words, that hold all ``terms``."""
        none = np.empty(0, np.int64)
        if (self.sizes[terms] == 0).any():
            return none, none
        terms = terms[np.argsort(self.sizes[terms], kind="stable")]
        lists = [self.places[self.first[t]:self.first[t] + self.sizes[t]] for t in terms]
        rare = lists[0]

        def close(places):
            after = np.searchsorted(rare, places)
            left = places - rare[np.maximum(after - 1, 0)]
            right = rare[np.minimum(after, len(rare) - 1)] - places
            return places[((after > 0) & (left < within)) | ((after < len(rare)) & (right < within))]

        lists = [rare, *(close(x) for x in lists[1:])]
        ends = np.unique(np.concatenate(lists))
        begin = ends.copy()
        for x in lists:
            if not len(x):
                return none, none
            before = np.searchsorted(x, ends, "right") - 1
            begin = np.where(before < 0, -1, np.minimum(begin, x[np.maximum(before, 0)]))
        keep = begin >= 0
        begin, ends = begin[keep], ends[keep]
        first = np.append(True, begin[1:] > begin[:-1])[:len(begin)]  # a later end from the same begin is not minimal
        begin, ends = begin[first], ends[first]
        keep = (ends - begin < within) & (self.doc_of(begin) == self.doc_of(ends))
        return begin[keep], ends[keep]


def _search(index: DataFrame, block: Block, body, schema: str, fields: list[pa.Field]) -> DataFrame:
    """Rows of ``schema``: for every segment, what ``body(Segment)`` gives as columns after the segment's number.

    The block, and so the table of its terms, is bounded: it is broadcast.
    """
    names = [t.decode() for t in block.terms]
    longest = max(map(len, block.words))
    wanted = F.broadcast(index.sparkSession.createDataFrame(pd.DataFrame({"term": names})))
    used = ["segment", "term", "postings", "starts", "lengths"]
    lists = index.where("term IS NOT NULL").join(wanted, "term", "left_semi").select(*used)
    layout = pa.schema([("segment", pa.int64()), *fields])

    def run(table: pa.Table) -> pa.Table:
        if table.num_rows == 1:  # none of the terms
            return layout.empty_table()
        columns = body(Segment(table, pa.array(names, pa.string()), longest))
        segment = np.full(len(columns[0]), table["segment"][0].as_py())
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip([segment, *columns], layout)], schema=layout)

    return index.where("term IS NULL").select(*used).unionByName(lists).groupBy("segment").applyInArrow(run, schema)


def _over_blocks(index: DataFrame, items: DataFrame, item_id: str, item_text: str, block_words: int, body, columns: str, fields) -> DataFrame:
    """The results of all blocks; each is written before the next block is read."""
    schema = f"segment long, {columns}"
    found = [materialise(_search(index, block, body(block), schema, fields), "postings-found") for block in blocks(items, item_id, item_text, block_words)]
    if not found:
        return index.sparkSession.createDataFrame([], schema)
    return found[0] if len(found) == 1 else reduce(DataFrame.unionByName, found)


def _kind(items: DataFrame, item_id: str) -> tuple[str, pa.DataType]:
    kind = items.schema[item_id].dataType
    return kind.simpleString(), to_arrow_type(kind)


def documents_of(index: DataFrame) -> DataFrame:
    """``segment``, ``row``, ``id``, ``start`` (place of the first word in the segment) and ``n_words`` of every indexed document."""
    return index.where("term IS NULL").select("segment", F.posexplode(F.arrays_zip("ids", "starts", "lengths")).alias("row", "doc")).select(
        "segment", "row", F.col("doc.ids").alias("id"), F.col("doc.starts").alias("start"), F.col("doc.lengths").cast("long").alias("n_words"))


def _placed(index: DataFrame, found: DataFrame) -> DataFrame:
    first, last = (F.col(c) - F.col("start") for c in ("first", "last"))
    return found.join(documents_of(index), ["segment", "row"]).select(
        "id", "segment", "row", "item", first.cast("long").alias("first"), last.cast("long").alias("last"))


def phrase_matches(index: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = 10,
                   block_words: int = 1 << 18) -> DataFrame:
    """Exact occurrences of the items' windows of ``window`` words (a shorter item is one window) in the indexed documents.

    One row per document, item and run of words that occurrences of its windows cover: ``id``, ``segment``, ``row``, ``item``, and ``first`` and ``last``, the numbers of the
    run's words in the document from 0. Items without words match nothing; repeated items match each. Runs of windows that touch are one.
    """
    name, arrow = _kind(items, item_id)

    def body(block: Block):
        def search(segment: Segment):
            item, first, last = [], [], []
            for rows, of_window, of_item in block.windows(window):
                hit, place = segment.phrases(rows)
                low, high = np.searchsorted(of_window, hit, "left"), np.searchsorted(of_window, hit, "right")
                at = np.repeat(low, high - low) + np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
                item.append(of_item[at])
                first.append(np.repeat(place, high - low))
                last.append(first[-1] + rows.shape[1] - 1)
            item, first, last = (np.concatenate(x) for x in (item, first, last))
            order = np.lexsort((first, item))
            item, first, last = item[order], first[order], last[order]
            new = np.append(True, (item[1:] != item[:-1]) | (first[1:] > last[:-1] + 1))[:len(item)]
            runs = np.flatnonzero(new)
            ends = last[np.append(runs[1:], len(item)) - 1] if len(runs) else last[:0]
            return [segment.doc_of(first[runs]), [block.ids[i] for i in item[runs]], first[runs], ends]

        return search

    found = _over_blocks(index, items, item_id, item_text, block_words, body, f"row int, item {name}, first int, last int",
                         [pa.field("row", pa.int32()), pa.field("item", arrow), pa.field("first", pa.int32()), pa.field("last", pa.int32())])
    return _placed(index, found)


def proximity_matches(index: DataFrame, items: DataFrame, within: int, item_id: str = "item_id", item_text: str = "text",
                      block_words: int = 1 << 18) -> DataFrame:
    """Minimal intervals of at most ``within`` words of one document in which all distinct words of an item occur, in any order.

    Columns as of ``phrase_matches``. Minimal: no shorter interval inside holds them all. Items without words match nothing.
    """
    name, arrow = _kind(items, item_id)

    def body(block: Block):
        def search(segment: Segment):
            found = [(i, *segment.near_places(np.unique(words), within)) for i, words in enumerate(block.words)]
            first = np.concatenate([f for _, f, _ in found])
            return [segment.doc_of(first), [block.ids[i] for i, f, _ in found for _ in f], first, np.concatenate([e for _, _, e in found])]

        return search

    found = _over_blocks(index, items, item_id, item_text, block_words, body, f"row int, item {name}, first int, last int",
                         [pa.field("row", pa.int32()), pa.field("item", arrow), pa.field("first", pa.int32()), pa.field("last", pa.int32())])
    return _placed(index, found)


def contamination(index: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = 10,
                  block_words: int = 1 << 18) -> DataFrame:
    """Per indexed document: ``id``, ``n_words``, ``n_hit`` (words inside an occurrence of any window of any item) and ``items`` (the distinct
    ids of the items with an occurring window, ascending as strings; an item of NULL id counts as the empty string).

    Each segment sums up its own documents, so a passage that many documents share is never gathered; of several blocks a document's covered spans are merged.
    """

    def body(block: Block):
        as_text = np.array(["" if i is None else str(i) for i in block.ids], object)

        def search(segment: Segment):
            pairs, cover = [np.empty((0, 2), np.int64)], np.zeros(segment.span + 1, np.int32)
            for rows, of_window, of_item in block.windows(window):
                hit, place = segment.phrases(rows)
                np.add.at(cover, place, 1)
                np.subtract.at(cover, place + rows.shape[1], 1)
                seen = np.unique(np.stack([segment.doc_of(place), hit], axis=1), axis=0)
                low, high = np.searchsorted(of_window, seen[:, 1], "left"), np.searchsorted(of_window, seen[:, 1], "right")
                at = np.repeat(low, high - low) + np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
                pairs.append(np.unique(np.stack([np.repeat(seen[:, 0], high - low), of_item[at]], axis=1), axis=0))
            pairs = np.unique(np.concatenate(pairs), axis=0)
            docs, at = np.unique(pairs[:, 0], return_index=True)
            items_of = [sorted(set(as_text[x])) for x in np.split(pairs[:, 1], at[1:])] if len(docs) else []
            inside = np.append(0, np.cumsum(cover)[:-1] > 0).astype(np.int8)
            edges = np.diff(np.append(inside, 0))
            begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            owner = segment.doc_of(begins)
            spans = [[{"first": int(a), "last": int(b) - 1} for a, b in zip(begins[l:r], ends[l:r])]
                     for l, r in zip(np.searchsorted(owner, docs, "left"), np.searchsorted(owner, docs, "right"))]
            return [docs, items_of, spans]

        return search

    span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    found = _over_blocks(index, items, item_id, item_text, block_words, body, "row int, items array<string>, spans array<struct<first:int,last:int>>",
                         [pa.field("row", pa.int32()), pa.field("items", pa.list_(pa.string())), pa.field("spans", span)])
    merged = found.groupBy("segment", "row").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                                 F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("upto"))
    covered = F.aggregate("spans", start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["upto"] + 1, s["first"]) + 1)).alias("n"), F.greatest(acc["upto"], s["last"]).alias("upto")))
    return documents_of(index).join(merged, ["segment", "row"], "left").select(
        "id", "n_words", F.coalesce(covered["n"], F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
