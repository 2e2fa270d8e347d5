"""The prefix trie against dictionaries of prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, low string, kind string"
COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)


def _digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def _paths(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, _digest(role, text), role, text)
            convs.setdefault(conv, []).append(key)
    return {c: tuple(t[3:] for t in sorted(turns)) for c, turns in convs.items()}


def _expected(paths):
    members, ends = {}, {}
    for conv, path in paths.items():
        ends.setdefault(path, []).append(conv)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in own) or 1
        last = len(node[-1][1]) if node else 0
        saved[node] = (len(members[node]) - 1) * last + sum(saved[c] for c in own)
    return sorted(
        (
            min(m), len(node), str(min(members[node[:-1]]) if node else None), len(m),
            len(children.get(node, [])), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def _read(df):
    assert sorted(df.columns) == sorted(COLUMNS)
    return sorted(tuple(str(r[c]) if c == "parent_conv_id" else r[c] for c in COLUMNS) for r in df.collect())


def _own(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    return prefix_trie.paths(df, "conv_id", "turn", "role", "text")


def _some(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 1, 2, 3, 6])):
            rows.append((conv * 3 - 50, turn, rng.choice("ua"), "t" * rng.choice([0, 1, 1, 1, 5])))
    return rows


@pytest.mark.parametrize("shard_rows", [1, 4, 1000])
def test_nodes_equal_brute_force(spark, shard_rows):
    rows = _some(shard_rows, 60)
    rows += [(c, t, "u", "alike") for c in range(1000, 1040) for t in range(4)]  # one path, many times
    rows += [(2000, t, "u", f"deep {t}") for t in range(300)]
    rows += [(2001, t, "u", f"deep {t}") for t in range(299)]
    rows += [(3000, None, None, None), (3001, 0, "", ""), (3002, 2, "a", "x"), (3002, None, "b", "y")]
    rows += [(3003, 1, "u", "same"), (3003, 1, "u", "same"), (3004, 1, "é", "😀" * 40_000)]
    rows += [(None, 0, "u", "no id")]
    got = _read(prefix_trie.nodes(_own(spark, rows), shard_rows))
    assert got == _expected(_paths(rows))


def test_a_hot_path_over_many_shards(spark):
    rows = [(c, t, "u", "hot") for c in range(150) for t in range(1 + c % 2)]
    rows += [(900 + c, t, "u", "hot" if t < 2 else str(c)) for c in range(20) for t in range(4)]
    assert _read(prefix_trie.nodes(_own(spark, rows), 5)) == _expected(_paths(rows))


def test_empty_table_and_turnless_paths(spark):
    assert prefix_trie.nodes(_own(spark, [])).count() == 0
    own = _own(spark, [(1, 0, "u", "x"), (9, 0, "u", "x")])
    bare = own.select("conv_id", F.slice("turns", 1, 0).alias("turns"))
    empty = hashlib.sha256(b"1,9").hexdigest()
    assert _read(prefix_trie.nodes(bare)) == [(1, 0, "None", 2, 0, 1, 0, empty)]


def test_rebuilt_from_bases(spark):
    rows = [(c, t, "u", f"{c} {t}") for c in [*range(-110, -95), 0, 1, 5, 99, 203, 204, 300, 301] for t in range(4)]
    rows += [(205, 0, "u", "short"), (206, 0, "u", "short")]
    conv_id = F.col("conv_id")
    head = (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")
    got = prefix_trie.rebuilt(_own(spark, rows), conv_id - conv_id % 100, head, 5).collect()
    paths = _paths(rows)
    want = {}
    for c in paths:
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        want[c] = [_digest(*t) for t in paths.get(base, ())[:h] + paths[c][h:]]
    assert {r.conv_id: [t.step for t in r.turns] for r in got} == want
    assert [] in want.values()


def test_extents_equal_scans():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 31, 64, 100):
        values = rng.integers(0, 5, n)
        minima = prefix_trie.Minima(values)
        at, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        for i, d, low, high in zip(at, depth, minima.left(at, depth), minima.right(at, depth)):
            assert low == next((j for j in range(i, 0, -1) if values[j] < d), 0)
            assert high == next((j - 1 for j in range(i + 1, n) if values[j] < d), n - 1)
        low, high = np.triu_indices(n)
        assert minima.least(low, high).tolist() == [values[a : b + 1].min() for a, b in zip(low, high)]
