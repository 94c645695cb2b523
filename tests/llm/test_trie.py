import hashlib
import random
import zlib

import numpy as np
import pytest

from tidemark.llm.trie import HEAD_TURNS, classes, path_keys, prefix_trie, rebuilt, sequences, turn_numbers

CONVERSATION = "conv_id long, turn long, role string, text string"


def table(spark, rows, extra=()):
    schema = CONVERSATION + "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], schema).repartition(3)


def listed(rows):
    """Turns of each conversation in order, as (role, text)."""
    def digest(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]

    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, digest(r))):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def with_heads(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences_):
    members = {}
    for c, turns in sequences_.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[:-1] == p] for p in members}

    def total(p):
        words = len(p[-1][1].split()) if p else 0
        leaves, saved = (0, (len(members[p]) - 1) * words) if children[p] else (1, (len(members[p]) - 1) * words)
        for q in children[p]:
            a, b = total(q)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for p, held in members.items():
        leaves, saved = total(p)
        ends = ",".join(str(c) for c in sorted(held) if len(sequences_[c]) == len(p))
        out.append((min(held), len(p), min(members[p[:-1]]) if p else None, len(held), len(children[p]), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(trie):
    return sorted((tuple(r) for r in trie.collect()), key=repr)


def talk(rng, conversations, longest=6):
    rows = []
    for c in conversations:
        length = rng.choice([1, 2, 3, longest])
        for t in range(length):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["one two", "three", "", "four five six", "é ü"])))
    return rows


@pytest.mark.parametrize("shard_bytes", [1, 400, 1 << 20])
def test_against_brute_force(spark, shard_bytes):
    rng = random.Random(shard_bytes)
    rows = talk(rng, [*range(-25, 45), 1_000_000, 1_000_001, 8_000_000_000])
    rows += [(60, None, "user", "first"), (60, 0, None, None), (60, 0, "user", "x"), (60, 0, "user", "x"), (None, 3, "user", "y")]
    df = table(spark, rows, ["words", "key", "n", "ends"])
    own = listed(rows)
    assert found(prefix_trie(sequences(df), shard_bytes)) == brute(own)
    assert found(prefix_trie(rebuilt(df), shard_bytes)) == brute(with_heads(own))


def test_long_conversations_and_large_classes(spark):
    """Sequences longer than a matrix block, that part in different blocks, and many equal ones."""
    rng = random.Random(7)
    trunk = [("user", f"w{i} x") for i in range(120)]
    rows = []
    for c in range(40):
        turns = trunk[:rng.choice([15, 16, 17, 48, 119])] + [("assistant", f"t{rng.randrange(3)}") for _ in range(rng.choice([0, 1, 40]))]
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    for c in range(5_000, 14_000, 3):  # one class over several chunks of ids
        rows.append((c, 0, "user", "hello there"))
    own = listed(rows)
    df = table(spark, rows)
    assert found(prefix_trie(sequences(df), 2_000)) == brute(own)
    one = {r.n: r for r in classes(sequences(df)).collect()}[3_000]
    assert one.conv_id == 5_000
    assert one.ends_sha256 == hashlib.sha256(",".join(map(str, range(5_000, 14_000, 3))).encode()).hexdigest()


def test_conversations_that_lose_their_turns(spark):
    """Too few own turns and no base: members of the root only."""
    gone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(gone, 0, "user", "a"), (gone, 1, "user", "b")]
    got = found(prefix_trie(rebuilt(table(spark, rows))))
    assert got == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())]
    assert HEAD_TURNS == 3


def test_empty_table_and_very_long_text(spark, long_text):
    assert prefix_trie(rebuilt(table(spark, []))).collect() == []
    assert prefix_trie(sequences(table(spark, [(None, 1, "user", "x")]))).collect() == []
    rows = [(1, 0, "user", long_text), (2, 0, "user", long_text), (2, 1, "user", "x")]
    assert found(prefix_trie(sequences(table(spark, rows)))) == brute(listed(rows))


def test_turn_numbers_and_path_keys():
    ids = [bytes([a] * 16) for a in (3, 0, 3, 255, 0)]
    numbers = turn_numbers(np.frombuffer(b"".join(ids), np.uint64))
    assert [[a == b for a in numbers] for b in numbers] == [[a == b for a in ids] for b in ids]
    assert path_keys(b"".join(ids))[2] == hashlib.sha256(b"".join(ids[:2])).digest() and len(path_keys(b"")) == 1
