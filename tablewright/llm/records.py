"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A record file is a run of frames, each

    length   unsigned 64 bits, little-endian
    masked CRC-32C of the length   unsigned 32 bits
    payload  ``length`` bytes
    masked CRC-32C of the payload  unsigned 32 bits

where masking rotates a checksum right by 15 bits and adds 0xA282EAD8. This is the framing of the widely read TFRecord
format. The payload is one sequence: magic ``TKS1``, bytes per id (2 or 4), whether the id is NULL, two zero bytes, the document's id
(signed 64 bits), the number of token ids (unsigned 64 bits), and the token ids, little-endian.

Files hold documents in ascending id order, and so do files by their part number. Beside the files, a Parquet index has a row
per record: file, place of the frame, length, id, tokens, and ``start``, the token ids of all documents before it. A shuffled read
takes the index in any order and reads each frame by its place.

A task writes to file names of its own attempt. The index is committed by Spark and names only the files of attempts that
succeeded, so a lost executor or a second attempt leaves files that nobody reads.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.common import batch_rows, filesystem, text_batches
from tablewright.llm.encode import encoder
from tablewright.session import materialise, release, scratch_path

# The reflected Castagnoli polynomial and the mask of the frame format.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8

HEAD = struct.Struct("<4sBBHqQ")
FRAME_EXTRA = 16
LANE = 256  # bytes per lane of the checksum


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Register change for two bytes at once, and for a register moved over ``LANE`` zero bytes, by byte of the register."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(POLYNOMIAL), byte >> 1).astype(np.uint32)
    pair = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(2):
        pair = byte[pair & 0xFF] ^ (pair >> 8)
    moved = []
    for shift in (0, 8, 16, 24):
        state = np.arange(256, dtype=np.uint32) << np.uint32(shift)
        for _ in range(LANE):
            state = byte[state & 0xFF] ^ (state >> 8)
        moved.append(state)
    return pair, moved


_PAIR, _MOVED = _tables()


def masked_crc32c(payloads: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of each payload (of 4 bytes or more), all side by side.

    Leading zero bytes do not move a zero register, so payloads are filled up at the front to whole lanes. Lanes run
    side by side; the registers of a payload's lanes are then folded from front to back.
    """
    if not payloads:
        return np.empty(0, np.uint32)
    sizes = np.array([len(p) for p in payloads], np.int64)
    lanes = -(-sizes // LANE)
    ends = np.cumsum(lanes)
    data = np.zeros(int(ends[-1]) * LANE, np.uint8)
    for p, size, end in zip(payloads, sizes, ends):
        lo = end * LANE - size
        data[lo:end * LANE] = np.frombuffer(p, np.uint8)
        data[lo:lo + 4] ^= 0xFF  # the register starts with all bits set
    words = np.ascontiguousarray(data.view("<u2").reshape(-1, LANE // 2).T)
    state = np.zeros(len(data) // LANE, np.uint32)
    for column in words:
        state = _PAIR[(state ^ column) & 0xFFFF] ^ (state >> np.uint32(16))
    first = ends - lanes
    total = state[first]
    for step in range(1, int(lanes.max())):
        more = np.flatnonzero(lanes > step)
        r = total[more]
        r = _MOVED[0][r & 0xFF] ^ _MOVED[1][(r >> 8) & 0xFF] ^ _MOVED[2][(r >> 16) & 0xFF] ^ _MOVED[3][r >> 24]
        total[more] = r ^ state[first[more] + step]
    crc = ~total
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def frames(sequences: list[tuple[int | None, bytes, int]]) -> list[bytes]:
    """Frames of (id, token ids as little-endian bytes, bytes per id)."""
    payloads = [HEAD.pack(b"TKS1", width, doc is None, 0, doc or 0, len(ids) // width) + ids for doc, ids, width in sequences]
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    sums = zip(masked_crc32c(lengths).tolist(), masked_crc32c(payloads).tolist())
    return [n + struct.pack("<I", a) + p + struct.pack("<I", b) for n, p, (a, b) in zip(lengths, payloads, sums)]


def parse_frames(raw: list[bytes]) -> list[tuple[int | None, np.ndarray]]:
    """(id, token ids) of each frame; an error if a length, checksum or head does not fit."""
    payloads = [r[12:-4] for r in raw]
    lengths = [r[:8] for r in raw]
    sums = zip(masked_crc32c(lengths).tolist(), masked_crc32c(payloads).tolist())
    found = []
    for r, n, p, (a, b) in zip(raw, lengths, payloads, sums):
        if struct.unpack("<Q", n)[0] != len(p) or struct.unpack("<I", r[8:12])[0] != a or struct.unpack("<I", r[-4:])[0] != b:
            raise ValueError("damaged record")
        magic, width, is_null, _, doc, count = HEAD.unpack_from(p)
        if magic != b"TKS1" or HEAD.size + width * count != len(p):
            raise ValueError("not a token record")
        found.append((None if is_null else doc, np.frombuffer(p, f"<u{width}", count, HEAD.size)))
    return found


def write_records(df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                  file_bytes: int = 256 << 20) -> DataFrame:
    """Encode each row's whole text, add ``end_id``, write the records under ``path``; returns the index.

    Rows go to range partitions by id and are written in ascending order, NULL ids first, rows of equal id by their
    text. A part starts a new file after ``file_bytes``. NULL text is empty: a record with the end id alone.
    An empty table gives no file and an empty index. Columns other than the two do not matter.
    """
    spark = df.sparkSession
    fs, root = filesystem(path)
    fs.create_dir(root, recursive=True)
    batch_rows(spark, 500)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        words = encoder(tokenizer)
        tail = np.array([end_id], words.dtype).tobytes()
        fs, root = filesystem(path)
        out, name, at, number, inside = None, "", 0, 0, 0
        try:
            for batch, texts in text_batches(batches, "text"):
                docs = batch.column("id").to_pylist()
                ids = [words.encode((t or b"").decode()) + tail for t in texts]
                rows = []
                for doc, seq, frame in zip(docs, ids, frames([(d, s, words.dtype.itemsize) for d, s in zip(docs, ids)])):
                    if out is not None and at + len(frame) > file_bytes:
                        out.close()
                        out, number = None, number + 1
                    if out is None:
                        name, at, inside = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.rec", 0, 0
                        out = fs.open_output_stream(f"{root}/{name}")
                    out.write(frame)
                    tokens = len(seq) // words.dtype.itemsize
                    rows.append((part, number, name, at, len(frame), doc, tokens, inside))
                    at, inside = at + len(frame), inside + tokens
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) if k != 5 else pa.array(c, pa.int64()) for k, c in enumerate(zip(*rows))],
                                                     names=["part", "file_no", "file", "place", "length", "id", "n_tokens", "inside"])
        finally:
            if out is not None:
                out.close()

    ordered = (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
               .repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text"))
    written = ordered.mapInArrow(run, "part long, file_no long, file string, place long, length long, id long, n_tokens long, inside long")
    rows = materialise(written, "record-rows")
    index = f"{path.rstrip('/')}/index"
    _with_starts(rows).write.parquet(index)
    release(rows)
    return spark.read.parquet(index)


def _with_starts(rows: DataFrame) -> DataFrame:
    """Add ``start``: the running sum within the file after the sum of the files before it.

    Files are summed in blocks of parts, so that no task sees all of them.
    """
    files = rows.groupBy("part", "file_no").agg(F.sum("n_tokens").alias("tokens")).withColumn("block", F.floor(F.col("part") / 1024))
    blocks = files.groupBy("block").agg(F.sum("tokens").alias("tokens"))
    before_block = blocks.withColumn("before", F.sum("tokens").over(
        Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).select("block", F.coalesce("before", F.lit(0)).alias("block_start"))
    in_block = Window.partitionBy("block").orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.withColumn("file_start", F.coalesce(F.sum("tokens").over(in_block), F.lit(0))).join(before_block, "block").select(
        "part", "file_no", (F.col("file_start") + F.col("block_start")).alias("file_start"))
    return rows.join(starts, ["part", "file_no"]).sortWithinPartitions("part", "file_no", "place").select(
        "part", "file_no", "file", "place", "length", "id", "n_tokens", (F.col("inside") + F.col("file_start")).alias("start"))


def read_records(spark: SparkSession, path: str, index: DataFrame | None = None, gap: int = 1 << 16, span: int = 8 << 20) -> DataFrame:
    """``id``, ``start`` and ``ids`` (array<long>) of each record that ``index`` names (all by default), in the index's order.

    Frames that lie within ``gap`` bytes of each other in a file are read in one range of up to ``span`` bytes; every
    checksum is verified.
    """
    read = _reader(path, gap, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in read(batches):
            found = parse_frames(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in found], pa.int64()), batch.column("start"), pa.array([t.astype(np.int64) for _, t in found], pa.list_(pa.int64()))],
                names=["id", "start", "ids"])

    index = spark.read.parquet(f"{path.rstrip('/')}/index") if index is None else index
    batch_rows(spark, 500)
    return index.select("file", "place", "length", "start").mapInArrow(run, "id long, start long, ids array<long>")


def digests(spark: SparkSession, path: str, index: DataFrame | None = None) -> DataFrame:
    """``id``, ``start``, ``n_tokens`` and ``ids_crc32`` (of the ids as 32-bit little-endian numbers), from the files."""
    import zlib

    read = _reader(path, 1 << 16, 8 << 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in read(batches):
            found = parse_frames(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in found], pa.int64()), batch.column("start"), pa.array([len(t) for _, t in found], pa.int64()),
                 pa.array([zlib.crc32(t.astype("<u4").tobytes()) for _, t in found], pa.int64())],
                names=["id", "start", "n_tokens", "ids_crc32"])

    index = spark.read.parquet(f"{path.rstrip('/')}/index") if index is None else index
    batch_rows(spark, 500)
    return index.select("file", "place", "length", "start").mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def _reader(path: str, gap: int, span: int):
    """Batches of the index with the frames of their rows."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
        fs, root = filesystem(path)
        name, source = None, None
        try:
            for batch in batches:
                files, places, lengths = (batch.column(c).to_pylist() for c in ("file", "place", "length"))
                raw: list[bytes] = []
                i = 0
                while i < len(files):
                    lo, hi, j = places[i], places[i] + lengths[i], i + 1
                    while (j < len(files) and files[j] == files[i] and hi <= places[j] <= hi + gap and places[j] + lengths[j] - lo <= span):
                        hi, j = places[j] + lengths[j], j + 1
                    if files[i] != name:
                        if source is not None:
                            source.close()
                        name, source = files[i], fs.open_input_file(f"{root}/{files[i]}")
                    data = source.read_at(hi - lo, lo)
                    raw += [data[places[k] - lo:places[k] - lo + lengths[k]] for k in range(i, j)]
                    i = j
                yield batch, raw
        finally:
            if source is not None:
                source.close()

    return read
