import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import records
from tablewright.llm.encode import Encoder, encoder

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def whole(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def checksum(data):
    """Bit by bit, from the definition."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ 0x82F63B78 * (crc & 1)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksum():
    data = [bytes(range(n % 256)) * 3 + b"tail" for n in (0, 1, 80, 84, 85, 86, 170, 255)] + [bytes(5), bytes(600)]
    assert records.masked_crc32c(data).tolist() == [checksum(d) for d in data]


@pytest.mark.parametrize("name", FILES)
def test_encoder_equals_the_library(name, rows_of, sf_dir, edge):
    encode, words = whole(name), Encoder(public_tokenizers.path(name))
    odd = [" a", "a ", "a  b", "a\n\nb", "\na", "a \n b", "a\tb", "it's 'S 's", "x² ½ Ⅷ ΣΑΣ İI", "\x1ca b\x1d", "<|endoftext|> a", "﻿x \x00", ""]
    rng = np.random.default_rng(1)
    odd += ["".join(rng.choice(list(" \n'stdlre.!,aB1²é\t Σ漢🙂́ "), rng.integers(1, 30))) for _ in range(3000)]
    for text in odd + [t for _, t, *_ in rows_of(sf_dir)[:60] + edge]:
        assert np.frombuffer(words.encode(text or ""), words.dtype).tolist() == encode(text), repr(text)[:80]


SPECIALS = ["<|endoftext|>", "a <|endoftext|> b", "<|startoftext|>x<|endoftext|>", "\n<|endoftext|>\n", "<|EndOfText|> \x00", "<|EndOfText|>\x00<|endoftext|>",
            "x<|endoftext|", "plain text", "  two <|startoftext|>  blanks é", "it's <|EndOfText|> 漢\x1c", "plain <|end oftext|>"]


@pytest.mark.parametrize("name", FILES)
def test_special_tokens_as_by_an_unchanged_tokenizer(name):
    unchanged, words = Tokenizer.from_file(public_tokenizers.path(name)), encoder(public_tokenizers.path(name))
    for text in SPECIALS * 2:
        assert np.frombuffer(words.encode(text), words.dtype).tolist() == unchanged.encode(text, add_special_tokens=False).ids, repr(text)


def test_records_of_texts_with_special_tokens(spark, make, tmp_path):
    unchanged = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    records.write_records(make(list(enumerate(SPECIALS))), str(tmp_path / "s"), public_tokenizers.path(FILES[0]), 1)
    want, start = [], 0
    for i, text in enumerate(SPECIALS):
        ids = unchanged.encode(text, add_special_tokens=False).ids + [1]
        want.append((i, start, ids))
        start += len(ids)
    assert sorted((tuple(r) for r in records.read_records(spark, str(tmp_path / "s")).collect()), key=lambda r: r[1]) == want


@pytest.mark.parametrize("file_bytes", [1 << 30, 20_000])
def test_round_trip(spark, make, edge, rows_of, sf_dir, tmp_path, file_bytes):
    rows = [r[:2] for r in rows_of(sf_dir)[50:]] + edge
    index = records.write_records(make(rows), str(tmp_path / "r"), public_tokenizers.path(FILES[0]), 1, file_bytes=file_bytes)
    encode = whole(FILES[0])
    want, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = encode(text) + [1]
        want.append((doc, start, ids))
        start += len(ids)
    got = sorted((tuple(r) for r in records.read_records(spark, str(tmp_path / "r")).collect()), key=lambda r: r[1])
    assert got == want
    digests = records.digests(spark, str(tmp_path / "r")).collect()
    assert sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in digests) == [
        (s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for _, s, ids in want]
    some = index.where("start % 3 = 0").orderBy(F.rand(3))  # a shuffled read of a part
    assert sorted(r["start"] for r in records.read_records(spark, str(tmp_path / "r"), some).collect()) == [s for _, s, _ in want if s % 3 == 0]


def test_damage_is_found():
    frame = records.frames([(7, np.arange(50, dtype="<u2").tobytes(), 2)])[0]
    assert records.parse_frames([frame])[0][1].tolist() == list(range(50))
    for place in (0, 9, 20, 60, len(frame) - 1):
        broken = bytearray(frame)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            records.parse_frames([bytes(broken)])


def test_empty_table(spark, make, tmp_path):
    index = records.write_records(make([]), str(tmp_path / "e"), public_tokenizers.path(FILES[0]), 1)
    assert index.count() == 0 and records.digests(spark, str(tmp_path / "e")).count() == 0
