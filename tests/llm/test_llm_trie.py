import hashlib
import random
import re
import zlib

import pytest

from tablewright.llm import prefix_trie
from tablewright.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, first long"


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def ordered(rows):
    """Turns of each conversation: (role, text), by turn, NULL first, then by digest."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn, role or "", text or ""))
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    return {c: [(r, t) for _, r, t in sorted(ts, key=lambda x: (x[0] is not None, x[0] or 0, digest(*x[1:])))] for c, ts in found.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * words_of(path[-1][1]) if path else 0
        leaves[path] = sum(leaves[k] for k in kids.get(path, [])) or 1
        saved[path] = own + sum(saved[k] for k in kids.get(path, []))
    out = []
    for path, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(convs[c]) == len(path))
        out.append((min(ms), len(path), min(members[path[:-1]]) if path else None, len(ms), len(kids.get(path, [])), leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame([(*r, "p", 1) for r in data], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(3)
    data = []
    for c in range(-40, 400):
        for t in range(rng.randint(1, 5)):
            data.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["yes", "no I said", "  "])))
    data += [(c, t, "user", f"hot {t}") for c in range(500, 700) for t in range(3)]  # many equal conversations
    data += [(c, t, "user", "deep") for c in (1000, 2000, 3000) for t in range(150)]  # a long shared chain
    data += [(800, None, None, None), (800, 1, "a", "b"), (800, 1, "a", "b"), (801, 1, "a", "long " * 30_000), (None, 1, "user", "lost"), (820, 2, "ab", "c"), (821, 2, "a", "bc")]
    data += [(c, 0, "user", "alone") for c in range(901, 920)]  # their base is absent
    return data


@pytest.mark.parametrize("shard_size", [7, 4096])
def test_against_brute_force(spark, talk, shard_size):
    convs = prefix_trie.conversations(frame(spark, talk))
    assert rows(prefix_trie.prefix_trie(convs, shard_size)) == brute(ordered(talk))


def test_rebuilt_conversations(spark, talk, tmp_path):
    frame(spark, talk).write.parquet(f"{tmp_path}/conversations.parquet")
    want = brute(rebuilt(ordered(talk)))
    assert rows(op12_prefix_trie(spark, str(tmp_path))) == want
    assert any(len(t) == 0 for t in rebuilt(ordered(talk)).values())  # ends at the root


def test_empty_and_single(spark):
    assert rows(prefix_trie.prefix_trie(prefix_trie.conversations(frame(spark, [(None, 1, "a", "b")]).where("conv_id = 1")))) == []
    one = [(4, 1, "user", "two words")]
    assert rows(prefix_trie.prefix_trie(prefix_trie.conversations(frame(spark, one)))) == brute(ordered(one))
