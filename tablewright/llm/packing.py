"""Best-fit packing of token sequences by swap-based local search.

Documents are encoded, ended, and cut into pieces of ``capacity`` tokens where they are longer (the first piece takes the rest).
Full pieces are sequences of their own. The others start from a best-fit packing, largest first, and are improved by local search:
the emptiest bin gives a document to a fuller bin, or exchanges one or two of its documents for a smaller one there, whenever that raises the
sum of squared fills, until the bin is empty or no exchange helps. Bins that stay empty are saved sequences. The search ends early
at the lower bound, tokens over capacity rounded up.

Packing needs no shuffle: each task packs the pieces of its partition, in groups of bounded size, and hands its last underfull
bins on. Those few pieces are packed once more, together, in tasks of ``group_tokens`` tokens.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import batch_rows, text_batches
from tablewright.llm.encode import encoder
from tablewright.session import materialise

SECOND = 1 << 61  # marks sequence ids of the second round


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: each item, largest first, goes to the bin it leaves least room in."""
    bins: list[list[int]] = []
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    by_room: dict[int, list[int]] = {}

    def put(room: int, number: int) -> None:
        if room:
            if room not in by_room:
                by_room[room] = []
                bisect.insort(rooms, room)
            by_room[room].append(number)

    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = bisect.bisect_left(rooms, lengths[item])
        if at == len(rooms):
            bins.append([item])
            put(capacity - lengths[item], len(bins) - 1)
            continue
        room = rooms[at]
        number = by_room[room].pop()
        if not by_room[room]:
            del by_room[room]
            rooms.pop(at)
        bins[number].append(item)
        put(room - lengths[item], number)
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, max_moves: int | None = None, tries: int | None = None) -> list[list[int]]:
    """Empty bins by moves that raise the sum of squared fills.

    It ends at the lower bound, or when every bin was tried since the last one was emptied; all items stay packed. ``tries`` bins that
    could not be emptied, or ``max_moves``, end it before. Every move raises the sum of squares, so it ends without them.

    The bin to empty, and the others, hold these as arrays: sizes of all documents of the other underfull bins, and the room there.
    """
    size = np.asarray(lengths, np.int64)
    fill = np.array([size[b].sum() for b in bins], np.int64)
    least = -(-int(size.sum()) // capacity)
    full = [b for b, f in zip(bins, fill) if f == capacity]
    open_ = sorted((b for b, f in zip(bins, fill) if f < capacity), key=lambda b: size[b].sum())
    kept: list[list[int]] = []  # could not be emptied; they still take documents
    moves, failed, emptied = 0, 0, False
    max_moves = float("inf") if max_moves is None else max_moves
    tries = float("inf") if tries is None else tries
    while len(full) + len(kept) + len(open_) > least and moves < max_moves and failed < tries:
        if not open_:
            if not emptied:
                break
            open_, kept, emptied = sorted(kept, key=lambda b: size[b].sum()), [], False
            continue
        mine = open_.pop(0)
        my_fill = int(size[mine].sum())
        others = open_ + kept
        owner = np.repeat(np.arange(len(others)), [len(b) for b in others])
        items = np.array([i for b in others for i in b], np.int64)
        room = capacity - np.array([size[b].sum() for b in others], np.int64)
        own_size = size[items]
        while mine and moves < max_moves:
            moves += 1
            best = None  # (gain, given, owner or place of the document taken)
            for i in mine:
                fits = np.flatnonzero((room >= size[i]) & (capacity - room + size[i] > my_fill))
                if len(fits):
                    k = int(fits[np.argmin(room[fits])])
                    if best is None or size[i] > best[0]:
                        best = (int(size[i]), (i,), k, None)
            if best is None and len(items):
                limit = room[owner]
                offers = [(i,) for i in mine] + [(i, j) for x, i in enumerate(mine) for j in mine[x + 1:]]
                for offer in offers:
                    gain = size[list(offer)].sum() - own_size
                    # The fuller bin must end fuller than this one was, so that the squares grow.
                    ok = (gain > 0) & (gain <= limit) & (capacity - limit + gain > my_fill)
                    if ok.any():
                        k = int(np.argmax(np.where(ok, gain, -1)))
                        if best is None or gain[k] > best[0]:
                            best = (int(gain[k]), offer, int(owner[k]), k)
            if best is None:
                break
            gain, given, to, taken = best
            for i in given:
                mine.remove(i)
                others[to].append(i)
            if taken is not None:
                back = int(items[taken])
                others[to].remove(back)
                mine.append(back)
                items, owner = np.delete(items, taken), np.delete(owner, taken)
            items, owner = np.append(items, given), np.append(owner, [to] * len(given))
            own_size = size[items]
            room[to] -= gain
            my_fill -= gain
        closed = {id(b) for b, r in zip(others, room) if not r}
        full += [b for b in others if id(b) in closed]
        open_ = sorted((b for b in open_ if id(b) not in closed), key=lambda b: size[b].sum())
        kept = [b for b in kept if id(b) not in closed]
        if mine:
            kept.append(mine)
            failed += 1
        else:
            emptied = True
    return [b for b in full + kept + open_ if b]


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def pieces_of(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only a document over ``capacity`` is cut, and the first piece takes the rest."""
    if n_tokens <= capacity:
        return [(0, n_tokens)]
    first = n_tokens % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n_tokens, capacity)]


_NAMES = ["id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset", "closed"]


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_NAMES)


def _batches(rows: Iterator[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 2000:
            yield _batch(held, id_type)
            held = []
    if held:
        yield _batch(held, id_type)


def _placed(pool: list[tuple], bins: list[list[int]], first_id: int, closed: bool) -> Iterator[tuple]:
    for number, members in enumerate(bins, first_id):
        offset = 0
        for i in members:
            yield (*pool[i], number, offset, closed)
            offset += pool[i][3]


def pack_documents(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
                   group_tokens: int = 8_000_000) -> DataFrame:
    """Pieces of all rows with their place: ``id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned, 2 bytes each if the
    vocabulary allows), ``ids_crc32`` (of the ids as 32-bit numbers), ``sequence_id`` and ``offset``.

    Every row is a document of its own, also if rows or ids repeat or the id is NULL. NULL and empty texts are the end id alone.
    An empty table gives an empty result; other columns do not matter. A task holds ``group_tokens`` tokens of pieces at a time.
    """
    id_type = df.select(id_col).schema[0].dataType.simpleString()
    schema = (f"id {id_type}, piece int, start long, length long, ids binary, ids_crc32 long, sequence_id long, offset long, closed boolean")

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        width = words.dtype.itemsize
        tail = np.array([end_id], words.dtype).tobytes()
        next_id = TaskContext.get().partitionId() << 32
        pool: list[tuple] = []
        held = 0
        kind = None

        def piece(doc, number, start, length, ids):
            part = ids[start * width:(start + length) * width]
            wide = part if width == 4 else np.frombuffer(part, words.dtype).astype("<u4").tobytes()
            return (doc, number, start, length, part, zlib.crc32(wide))

        def settle(last: bool) -> tuple[list[tuple], list[tuple]]:
            """Rows of bins that are full enough, or of all at the end, and the pieces of the others."""
            nonlocal next_id
            bins = pack([p[3] for p in pool], capacity)
            fills = [sum(pool[i][3] for i in b) for b in bins]
            done = [b for b, f in zip(bins, fills) if 256 * (capacity - f) <= capacity]
            rest = [b for b, f in zip(bins, fills) if 256 * (capacity - f) > capacity]
            rows = list(_placed(pool, done, next_id, True))
            next_id += len(done)
            if last:
                rows += _placed(pool, rest, next_id, False)
                next_id += len(rest)
                return rows, []
            return rows, [pool[i] for b in rest for i in b]

        def documents() -> Iterator[tuple[object, str]]:
            nonlocal kind
            for batch, texts in text_batches(batches, "text"):
                kind = batch.column("id").type
                for doc, text in zip(batch.column("id").to_pylist(), texts):
                    yield doc, (text or b"").decode()

        for some in words.encode_all(documents()):
            rows = []
            for doc, ids in some:
                ids += tail
                for number, (start, length) in enumerate(pieces_of(len(ids) // width, capacity)):
                    made = piece(doc, number, start, length, ids)
                    if length == capacity:
                        rows.append((*made, next_id, 0, True))
                        next_id += 1
                    else:
                        pool.append(made)
                        held += length
            yield from _batches(iter(rows), kind)
            if held > group_tokens:
                rows, pool = settle(False)
                held = sum(p[3] for p in pool)
                yield from _batches(iter(rows), kind)
        if pool:
            yield from _batches(iter(settle(True)[0]), kind)

    def second_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = SECOND | (TaskContext.get().partitionId() << 32)
        pool: list[tuple] = []
        held, kind = 0, None
        for batch in batches:
            kind = batch.column("id").type
            pool += zip(*(batch.column(c).to_pylist() for c in _NAMES[:6]))
            held = sum(p[3] for p in pool)
            if held > 4 * group_tokens:
                bins = pack([p[3] for p in pool], capacity)
                yield from _batches(_placed(pool, bins, next_id, True), kind)
                next_id, pool = next_id + len(bins), []
        if pool:
            yield from _batches(_placed(pool, pack([p[3] for p in pool], capacity), next_id, True), kind)

    batch_rows(df.sparkSession, 500)
    documents = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    packed = materialise(documents.mapInArrow(first_round, schema), "packed")
    tokens = packed.where(~F.col("closed")).agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-tokens // group_tokens))
    again = packed.where(~F.col("closed")).repartition(tasks).mapInArrow(second_round, schema)
    return packed.where("closed").unionByName(again).drop("closed")
