import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablewright.llm import encode, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(got, rows, capacity):
    """Every document is there once, cut as it should be, and sequences are gapless."""
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want, total = [], 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        first = len(ids) % capacity or min(capacity, len(ids))
        starts = [0, *range(first, len(ids), capacity)]
        for k, s in enumerate(starts):
            part = ids[s:first if k == 0 else s + capacity]
            want.append((doc, k, s, len(part), tuple(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    found = [(r["id"], r["piece"], r["start"], r["length"], tuple(np.frombuffer(r["ids"], "<u2").tolist()), r["ids_crc32"]) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= capacity
    return len(by), -(-total // capacity)


@pytest.mark.parametrize("capacity,group,parts", [(2048, 8_000_000, 3), (256, 3000, 3), (2048, 8_000_000, 40)])
def test_pieces_and_fill(make, edge, rows_of, sf_dir, capacity, group, parts):
    rows = [r[:2] for r in rows_of(sf_dir)] + edge
    got = packing.pack_documents(make(rows, parts), PATH, 0, capacity=capacity, group_tokens=group).collect()
    n, least = check(got, rows, capacity)
    assert n <= least * 1.02 + 1


def test_empty_table(make):
    assert packing.pack_documents(make([]), PATH, 0).collect() == []


def test_special_tokens_as_by_an_unchanged_tokenizer(make):
    unchanged = Tokenizer.from_file(PATH)
    rows = [(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "plain"), (4, "<|endoftext|> word" * 30)]
    got = {(r["id"], r["start"]): np.frombuffer(r["ids"], "<u2").tolist() for r in packing.pack_documents(make(rows), PATH, 0).collect()}
    assert got == {(i, 0): unchanged.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}


def test_pieces_of():
    assert packing.pieces_of(5, 4) == [(0, 1), (1, 4)]
    assert packing.pieces_of(8, 4) == [(0, 4), (4, 4)]
    assert packing.pieces_of(4, 4) == [(0, 4)] and packing.pieces_of(1, 4) == [(0, 1)]


@pytest.mark.parametrize("high", [400, 900])
def test_local_search_empties_bins(high):
    rng = random.Random(4)
    lengths = [rng.randint(1, high) for _ in range(400)]
    bins, room = [], 0
    for i, n in enumerate(lengths):  # next fit: a poor start
        if n > room:
            bins.append([])
            room = 2048
        bins[-1].append(i)
        room -= n
    squares = sum(sum(lengths[i] for i in b) ** 2 for b in bins)
    better = packing.local_search([list(b) for b in bins], lengths, 2048, tries=50)
    assert sorted(i for b in better for i in b) == list(range(len(lengths)))
    fills = [sum(lengths[i] for i in b) for b in better]
    assert max(fills) <= 2048 and len(better) < len(bins) and sum(f * f for f in fills) > squares
    assert len(better) <= -(-sum(lengths) // 2048) + 1
    assert len(packing.pack(lengths, 2048)) <= len(better)


def test_search_goes_on_where_best_fit_is_poor():
    rng = random.Random(1)
    lengths = [rng.randint(400, 900) for _ in range(600)]
    start = packing.best_fit(lengths, 2048)
    got = packing.pack(lengths, 2048)
    assert sorted(i for b in got for i in b) == list(range(len(lengths)))
    assert max(sum(lengths[i] for i in b) for b in got) <= 2048
    assert len(start) == 206 and len(got) <= 197 and -(-sum(lengths) // 2048) == 192


class Counting:
    """A model that counts how often it is asked."""

    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self.model.tokenize(text)


def test_new_words_go_through_the_model_together():
    rng = random.Random(7)
    distinct = ["".join(rng.choices("aeinorst", k=10)) for _ in range(20_000)]
    texts = [" ".join(distinct[k:k + 400]) + rng.choice(["", ".", "%%%"]) for k in range(0, 20_000, 200)]
    words = encode.Encoder(PATH, specials=True)
    words.model = Counting(words.model)
    got = [ids for some in words.encode_all(enumerate(texts)) for _, ids in some]
    assert words.model.calls < len(set(distinct)) / 100
    library = Tokenizer.from_file(PATH)
    assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_are_held_in_bounded_lists(monkeypatch):
    monkeypatch.setattr(encode, "TEXTS", 10)
    words = encode.Encoder(PATH, specials=True)
    assert [len(some) for some in words.encode_all((k, "") for k in range(25))] == [10, 10, 5]
    monkeypatch.setattr(encode, "TOGETHER", 20)
    assert [len(some) for some in words.encode_all((k, "ten marks.") for k in range(7))] == [3, 3, 1]


@pytest.mark.parametrize("together", [encode.TOGETHER, 200])
@pytest.mark.parametrize("uncut", [encode.UNCUT, ()])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_together_equal_the_library(monkeypatch, rows_of, sf_dir, edge, name, uncut, together):
    monkeypatch.setattr(encode, "TOGETHER", together)
    monkeypatch.setattr(encode, "UNCUT", uncut)
    path = public_tokenizers.path(name)
    texts = ["", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "\na", "a\n", "a \nb", "a\n b", "a\tb", "a\t", "\ta", "a \x1c", "a\r\nb", "a\u2028b",
             "it's 'S 's don't'", "x' y's' z'", "x² ½ Ⅷ ΣΑΣ İI", "ÿ Āǿ ɏ ɐ ª º µ × ÷", "\n.", ". , --- a.b a1 1a", "w\u0301 e\u0301.", "<|endoftext|> a",
             "a<|startoftext|>\n<|endoftext|>b", "\ufeffx \x00 \xa0", "\n".join(["one two"] * 3)]
    rng = np.random.default_rng(3)
    texts += ["".join(rng.choice(list(" \n'stdlre.!,aB1²é\tΣ漢🙂\u0301ÿ%"), rng.integers(1, 30))) for _ in range(3000)]
    texts += [" ".join("".join(rng.choice(list("'sdabÉß.,%-_1"), rng.integers(1, 6))) for _ in range(20)) for _ in range(500)]
    texts += [t or "" for _, t, *_ in rows_of(sf_dir)[:60] + edge]
    library = Tokenizer.from_file(path)
    words = encode.Encoder(path, specials=True)
    got = [pair for some in words.encode_all(enumerate(texts)) for pair in some]
    assert [k for k, _ in got] == list(range(len(texts))) and list(words.encode_all([])) == []
    for k, ids in got:
        assert np.frombuffer(ids, words.dtype).tolist() == library.encode(texts[k], add_special_tokens=False).ids, repr(texts[k])[:80]


@pytest.mark.parametrize("change", [{"ignore_merges": True}, {"end_of_word_suffix": "</w>"}, {"vocab": None}])
def test_models_that_cannot_take_words_together(tmp_path, change):
    with open(PATH, encoding="utf-8") as source:
        plan = json.load(source)
    if "vocab" in change:  # a merge for every byte that could stand between words
        letters = encode._byte_letters()
        spare = [letters[b] for b in (0xC0, 0xC1, *range(0xF5, 0x100))]
        for letter in spare:
            plan["model"]["vocab"]["a" + letter] = len(plan["model"]["vocab"])
            plan["model"]["merges"].append("a " + letter if isinstance(plan["model"]["merges"][0], str) else ["a", letter])
    else:
        plan["model"].update(change)
    path = tmp_path / "t.json"
    path.write_text(json.dumps(plan), encoding="utf-8")
    words = encode.Encoder(str(path))
    assert words.joint is None
    texts = ["some words, and some more words.", "a  b", "é a"]
    assert [ids for some in words.encode_all(enumerate(texts)) for _, ids in some] == [words.encode(t) for t in texts]
