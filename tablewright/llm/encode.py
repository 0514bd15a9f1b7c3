"""Token ids by a ``tokenizers`` file, with each distinct word encoded once per worker.

A text is cut at single blanks and line feeds between words, where no token of these tokenizers can cross, and the ids of the pieces
are looked up. A piece that is not known yet is cut by the tokenizer's own pattern, and its parts go through the tokenizer's model.
Texts with other white space or with the string of an added token, and tokenizers of another build, go through ``Tokenizer.encode``
whole. Either way the ids are those of ``Tokenizer.encode`` with ``add_special_tokens=False``: a special token's string in a text is its
single id. ``Encoder(path)`` by itself takes these strings as ordinary text (the library's ``encode_special_tokens``); the operators use ``encoder``.

``encode_all`` takes many texts and looks up each distinct piece of them once; words of Latin letters go through the model together,
joined by a byte that no text and no merge has.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

WORDS = 200_000  # pieces kept per generation; a worker holds two
JOINED = 200  # parts that go through the model at a time
TOGETHER = 8_000_000  # characters of texts whose pieces are looked up at a time
TEXTS = 100_000  # texts at a time, where they are short

# The pattern of byte-level tokenizers that do not carry one in their file.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The commonest signs that a text is not cut at single blanks and line feeds alone.
UNCUT = ("  ", "\n\n", " \n", "\n ", "\t", "\r")

LATIN = re.compile("[\\x00-\u024f]+")

# A word of Latin letters with the signs after it: two parts by the byte-level pattern. The line feed marks a word without a blank.
PLAIN = "^(?P<lead>\n?)(?P<word>[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)(?P<signs>[!-/:-@\\[-`{-~]*)$"

_loaded: dict[str, Encoder] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible in Latin-1, else the next free one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    stand_in = {b: 0x100 + i for i, b in enumerate(hidden)}
    return [chr(stand_in.get(b, b)) for b in range(256)]


class _Known(dict):
    """Ids, as little-endian bytes, of pieces; a missing one is encoded.

    When a generation is full it becomes the old one, and only pieces that come up again move over, so that the memory stays bounded
    and frequent pieces stay known.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece):
        ids = self.old.pop(piece, None)
        if ids is None:
            ids = self.encode(piece)
        self[piece] = ids
        return ids

    def turn(self) -> None:
        if len(self) > WORDS:
            self.old = dict(self)
            self.clear()


class Encoder:
    """Ids of texts as bytes of ``dtype`` (unsigned, little-endian, 2 bytes if the vocabulary allows).

    With ``specials``, the strings of special tokens are these tokens, as by the library's default; else they are ordinary text.
    """

    def __init__(self, path: str, specials: bool = False):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as source:
            plan = json.load(source)
        added = plan.get("added_tokens") or []
        self.specials = [t["content"] for t in added if t["content"]] if specials else []
        self.blank = self._blank(plan) if all(t["special"] and not t["normalized"] for t in added) else None
        # Pieces are parts of texts without added tokens, and folding must not make one of them.
        self.tokenizer.encode_special_tokens = not specials or self.blank is not None
        if self.blank is not None:
            self.letters = str.maketrans({b: c for b, c in enumerate(_byte_letters()) if chr(b) != c})
            self.model, self.code = self.tokenizer.model, "H" if self.dtype.itemsize == 2 else "I"
            self.first, self.rest = _Known(self._piece), _Known(lambda w: self._piece(self.blank + w))
            self.feed = self._whole("\n") if self.blank else b""
            self.joint = self._joint(plan["model"]) if self.blank else None

    def _blank(self, plan: dict) -> str | None:
        """What a blank adds to the word after it: itself, or nothing where white space is dropped; None: not a known build."""
        pre, norm = plan.get("pre_tokenizer") or {}, plan.get("normalizer")
        if plan["model"].get("type") != "BPE" or plan.get("post_processor", {}) and plan["post_processor"].get("type") not in (
                "ByteLevel", "TemplateProcessing", "RobertaProcessing"):
            return None
        if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"] and norm is None:
            self.pattern, self.lower = regex.compile(BYTE_LEVEL), False
            return " "
        steps = pre.get("pretokenizers") or [{}]
        folded = [n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        if (len(steps) == 2 and steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
                and steps[1].get("type") == "ByteLevel" and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"] and folded):
            self.pattern, self.lower = regex.compile(steps[0]["pattern"]["Regex"]), True
            return ""
        return None

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _model_ids(self, part: str) -> bytes:
        if part.isascii():  # visible bytes stand for themselves
            letters = "\u0120" + part[1:] if part[0] == " " else part
        else:
            letters = part.encode().decode("latin-1").translate(self.letters)
        ids = array(self.code, [t.id for t in self.model.tokenize(letters)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        if self.lower:
            # In these ranges every letter is composed already, and lower case does not depend on the letters around.
            folded = piece.lower() if piece.isascii() or LATIN.fullmatch(piece) else self.tokenizer.normalizer.normalize_str(piece)
            if folded != piece:
                return self.rest[folded]
        core = piece[1:] if self.blank and piece[0] == " " else piece
        if core.isalpha():
            return self._model_ids(piece)
        if not core or not core.isprintable():  # characters that two pattern engines may class differently
            return self._whole(piece)
        if core[-1] in ".,;:!?" and core[:-1].isalpha():
            parts = [piece[:-1], piece[-1]]
        else:
            parts = self.pattern.findall(piece)
        if len(parts) == 1:
            return self._model_ids(parts[0])
        return b"".join([self.rest[p[1:]] if p[0] == " " else self.first[p] for p in parts])

    def encode(self, text: str) -> bytes:
        """Ids of the whole text."""
        if self.blank is None:
            return self._whole(text)
        if any(t in text for t in self.specials):
            self.tokenizer.encode_special_tokens = False
            try:
                return self._whole(text)
            finally:
                self.tokenizer.encode_special_tokens = True
        self.rest.turn()
        self.first.turn()
        if not self.blank:  # white space never reaches a token
            return b"".join(map(self.rest.__getitem__, text.replace("\n", " ").split(" ")))
        out, rest, first = [], self.rest, self.first
        for i, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if words != line.split():  # blanks side by side, at an end, or other white space
                return self._whole(text)
            if i:
                out.append(self.feed)
            out.append(first[words[0]])
            out.extend(map(rest.__getitem__, words[1:]))
        return b"".join(out)

    def _joint(self, model: dict) -> tuple[str, int] | None:
        """The model's letter of each byte, the line feed's being that of a byte in no UTF-8 text and in no merge, and the id of that one.
        None: the model takes parts one by one."""
        if any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
            return None
        letters = _byte_letters()
        merged = set("".join(m if isinstance(m, str) else "".join(m) for m in model["merges"]))
        free = [letters[b] for b in (0xC0, 0xC1, *range(0xF5, 0x100)) if letters[b] not in merged and letters[b] in model["vocab"]]
        if not free:
            return None
        letters[0x0A] = free[-1]
        return "".join(letters), model["vocab"][free[-1]]

    def _joint_ids(self, parts: pa.Array) -> pa.Array:
        """Ids of each part by itself; no part holds a line feed."""
        letters, between = self.joint
        ended = pc.binary_join_element_wise(parts, pa.scalar("\n", parts.type), pa.scalar("", parts.type))
        ends = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset:][:len(parts) + 1]
        raw = memoryview(ended.buffers()[2] or b"")
        ids = [np.empty(0, self.dtype)]
        for at in range(0, len(parts), JOINED):
            spelt = codecs.charmap_decode(raw[ends[at]:ends[min(at + JOINED, len(parts))]], "strict", letters)[0]
            ids.append(np.array([t.id for t in self.model.tokenize(spelt)], self.dtype))
        ids = np.concatenate(ids)
        places = np.append(0, np.flatnonzero(ids == between) - np.arange(len(parts))) * ids.itemsize
        kept = ids[ids != between]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(kept)])

    def _piece_ids(self, keys: pa.Array) -> pa.Array:
        """Ids of distinct pieces: with a blank before, or, where the key begins with a line feed, of that and the piece. NULL: no piece."""
        binary = pa.large_binary()
        found = pc.extract_regex(keys, pattern=PLAIN)
        plain = found.is_valid()
        some = found.filter(plain)
        first = pc.equal(some.field("lead"), "\n")
        nothing = pa.scalar("", keys.type)
        spelt = pc.binary_join_element_wise(pc.if_else(first, nothing, pa.scalar(" ", keys.type)), some.field("word"), nothing)
        parts = pa.concat_arrays([spelt, some.field("signs")]).dictionary_encode()
        ids = self._joint_ids(parts.dictionary).take(parts.indices)
        nothing = pa.scalar(b"", binary)
        joined = pc.binary_join_element_wise(pc.if_else(first, pa.scalar(self.feed, binary), nothing), ids[:len(some)], ids[len(some):], nothing)
        others = []
        for key in keys.filter(pc.invert(plain)).to_pylist():
            core = key[1:] if key[:1] == "\n" else key
            if core.split() != [core]:  # blanks or line feeds side by side, at an end, or other white space
                others.append(None)
            else:
                others.append(self.feed + self.first[core] if core is not key else self.rest[core])
        order = np.argsort(np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable"))
        return pa.concat_arrays([joined, pa.array(others, binary)]).take(pa.array(order))

    def _looked_up(self, texts: list[str]) -> list[bytes | None]:
        """Ids of texts by their pieces, each distinct one looked up once; None: the text holds what is no piece."""
        if not texts:
            return []
        self.rest.turn()
        self.first.turn()
        lines = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        lines = pc.binary_join_element_wise(pa.scalar("\n", lines.type), lines, pa.scalar("", lines.type))
        pieces = pc.split_pattern(lines, " ")
        coded = pieces.flatten().dictionary_encode()
        ids = self._piece_ids(coded.dictionary).take(coded.indices)
        first = pieces.offsets.to_numpy()
        places = np.frombuffer(ids.buffers()[1], np.int64)[first].tolist()
        lost = np.append(0, np.cumsum(ids.is_null().to_numpy(zero_copy_only=False)))[first]
        raw = memoryview(ids.buffers()[2] or b"")
        return [None if gap else raw[start + len(self.feed):end].tobytes() for start, end, gap in zip(places, places[1:], np.diff(lost))]

    def encode_all(self, documents: Iterable[tuple[object, str]]) -> Iterator[list[tuple[object, bytes]]]:
        """(key, ids) of whole texts from (key, text), the ids as ``encode`` gives them, in lists for some millions of characters."""
        some, size = [], 0
        for document in documents:
            some.append(document)
            size += len(document[1])
            if size > TOGETHER or len(some) == TEXTS:
                yield self._encoded(some)
                some, size = [], 0
        if some:
            yield self._encoded(some)

    def _encoded(self, documents: list[tuple[object, str]]) -> list[tuple[object, bytes]]:
        if self.blank is None or self.joint is None:
            return [(key, self.encode(text)) for key, text in documents]
        alone = [any(s in text for s in (*UNCUT, *self.specials)) for _, text in documents]
        found = iter(self._looked_up([text for (_, text), a in zip(documents, alone) if not a]))
        ids = [None if a else next(found) for a in alone]
        return [(key, self.encode(text) if i is None else i) for (key, text), i in zip(documents, ids)]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    if path not in _loaded:
        _loaded[path] = Encoder(path, specials=True)
    return _loaded[path]
