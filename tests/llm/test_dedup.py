"""Exact, SimHash, suffix and embedding deduplication against brute force."""

import hashlib
import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import embedding_dedup, exact_dedup, simhash, suffix_dedup
from tidemark.llm.components import components

DOCS = "doc_id long, text string, keep_id string, `row` string"


def _union(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# -- components -----------------------------------------------------------------


def test_components_of_a_path_a_star_and_odd_links(spark):
    pairs = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)]
    pairs += [(7, 7), (None, 3), (200, 200)]
    found = components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()
    got = {r.node: r.component for r in found}
    assert got == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 140)}


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


# -- exact ----------------------------------------------------------------------


def test_exact_membership_of_odd_rows(spark):
    rows = [
        (5, "a  b", "k", "r"), (3, "a\tb", "k", "r"), (9, "a b ", "k", "r"),
        (4, None, "k", "r"), (2, "", "k", "r"), (8, " \n", "k", "r"), (7, "\x0b", "k", "r"),
        (None, "a\nb", "k", "r"), (6, "é" * 50_000, "k", "r"), (6, "é" * 50_000, "k", "r"),
    ]
    found = exact_dedup.membership(spark.createDataFrame(rows, DOCS), "doc_id", "text").collect()
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found}
    assert got == {
        (5, 3, 3, False), (3, 3, 3, True), (None, 3, 3, False), (9, 9, 1, True),
        (4, 2, 2, False), (2, 2, 2, True), (8, 7, 2, False), (7, 7, 2, True),
        (6, 6, 2, True),
    }
    digests = {r.doc_id: r.text_sha256 for r in found}
    assert digests[5] == hashlib.sha256(b"a b").hexdigest()
    assert len(found) == len(rows)


def test_exact_first_copies_keep_one_row_and_all_columns(spark):
    rows = [(1, "x", "a", "b"), (1, "x", "a", "b"), (None, "x", "a", "b"), (None, None, None, None)]
    kept = exact_dedup.first_copies(spark.createDataFrame(rows, DOCS), "doc_id", "text")
    assert kept.columns == ["doc_id", "text", "keep_id", "row"]
    assert {tuple(r) for r in kept.collect()} == {rows[0], rows[3]}
    assert exact_dedup.first_copies(kept.limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("budget", [1, 3_000, 1 << 30])
@pytest.mark.parametrize("give_up", [True, False])
def test_tries_of_any_budget_find_the_same_owners(budget, give_up):
    rng = random.Random(budget)
    texts = ["".join(rng.choices("ab ", k=rng.randrange(12))) for _ in range(600)]
    texts += ["common start " + t for t in texts[:300]] + ["z" * 5000] * 3
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    schema = pa.schema([("_id", pa.int64()), ("_text", pa.string()), ("_count", pa.int64())])
    batches = [
        pa.RecordBatch.from_pylist(
            [{"_id": i, "_text": t, "_count": 1} for i, t in rows[at : at + 50]], schema=schema
        )
        for at in range(0, len(rows), 50)
    ]
    # What is given up meets again in a later trie.
    found = exact_dedup.owners_of(iter(batches), budget, give_up)
    found = exact_dedup.owners_of(found, 1 << 30, False)
    got = {(r["_id"], r["_count"]) for b in found for r in b.to_pylist()}
    groups = {}
    for i, t in rows:
        groups.setdefault(exact_dedup.normalise(t.encode()), []).append(i)
    assert got == {(min(g), len(g)) for g in groups.values()}


# -- SimHash ----------------------------------------------------------------------


def _plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _near_texts(rng, n):
    words = ["".join(rng.choices("abcdeÉ", k=4)) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randrange(1, 200))) for _ in range(n)]
    texts = list(base)
    for text in base:
        for _ in range(rng.randrange(4)):
            own = text.split()
            own[rng.randrange(len(own))] = rng.choice(words).upper()
            texts.append("  ".join(own))
    return texts + [None, "", " \t", "One", "one", "Two words"]


@pytest.mark.parametrize("block", [3, 2048])
def test_simhash_links_as_all_pairs_do(spark, block):
    texts = _near_texts(random.Random(4), 60)
    prints = [_plain_fingerprint(t) for t in texts]
    table = spark.createDataFrame(
        [(p - (1 << 64) if p >> 63 else p,) for p in set(prints)], "fp long"
    )
    links = simhash.linked(table, 4, block).collect()
    distinct = sorted(set(prints))
    at = {p: i for i, p in enumerate(distinct)}
    mask = (1 << 64) - 1
    found = _union(len(distinct), [(at[r.a & mask], at[r.b & mask]) for r in links])
    near = [
        (i, j)
        for i, j in itertools.combinations(range(len(distinct)), 2)
        if (distinct[i] ^ distinct[j]).bit_count() <= 4
    ]
    assert near and found == _union(len(distinct), near)
    assert all(((r.a ^ r.b) & mask).bit_count() <= 4 for r in links)


def test_simhash_rows(spark):
    texts = _near_texts(random.Random(5), 25)
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "One", "x", "y"), (3, "One", "x", "y")]
    df = spark.createDataFrame(rows, DOCS)
    found = simhash.near_duplicates(df, "doc_id", "text").collect()
    assert len(found) == len(rows)
    prints = [_plain_fingerprint(r[1]) for r in rows]
    roots = _union(len(rows), [
        (i, j) for i, j in itertools.combinations(range(len(rows)), 2)
        if (prints[i] ^ prints[j]).bit_count() <= 4
    ])
    least = {}
    for root, row in zip(roots, rows):
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    want = sorted((str(r[0]), f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found) == want
    kept = simhash.first_of_groups(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert kept.count() == len(set(roots))
    assert simhash.first_of_groups(df.limit(0), "doc_id", "text").count() == 0


# -- repeated byte strings ----------------------------------------------------------


def _plain_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd, length", [(1, 80), (3000, 80), (3000, 160)])
def test_suffix_removal_as_brute_force(spark, crowd, length):
    rng = random.Random(8)

    def prose(n):
        return "".join(rng.choices("abcdefé \n", k=n))

    shared = [prose(300) for _ in range(4)]
    texts = [prose(rng.randrange(400)) for _ in range(15)]
    for _ in range(30):
        a = rng.randrange(150)
        texts.append(prose(rng.randrange(90)) + rng.choice(shared)[a : a + rng.randrange(60, 200)] + prose(30))
    texts += [shared[0]] * 3 + [None, "", "ab" * 200, "x" * 79, "x" * 500, shared[1] + shared[1]]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    found = suffix_dedup.without_repeats(df, "doc_id", "text", length, crowd).collect()
    got = [tuple(r)[1:] for r in sorted(found, key=lambda r: r.doc_id)]
    assert got == _plain_removal(texts, length)


def test_suffix_removal_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert suffix_dedup.without_repeats(empty, "doc_id", "text").count() == 0


def test_slices_of_a_long_text_lose_no_window(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SLICE", 500)
    data = bytes(random.Random(1).choices(b"abcd", k=3000))
    rolling = suffix_dedup._Rolling()
    starts = []
    for at, part in suffix_dedup._slices(data, 400):
        first, last, _ = suffix_dedup._runs(np.frombuffer(part, np.uint8), rolling, 400)
        starts += [at + s for a, b in zip(first, last) for s in range(a, b + 1)]
    assert starts == list(range(len(data) - 399))


def test_shards_do_not_change_what_is_found(monkeypatch):
    rng = random.Random(2)
    base = bytes(rng.choices(b"ab\0", k=900))
    snippets = [base[a : a + 500] for a in rng.sample(range(400), 30)]
    windows, weights = np.full(30, 101), np.ones(30, dtype=int)
    one, _ = suffix_dedup.repeated_starts(snippets, windows, weights, 400)
    monkeypatch.setattr(suffix_dedup, "SHARD_POSITIONS", 1200)
    many, _ = suffix_dedup.repeated_starts(snippets, windows, weights, 400)
    assert (one == many).all() and one.any() and not one.all()


def test_letters_that_hash_alike_are_told_apart_by_bytes(monkeypatch):
    rng = random.Random(4)
    base = bytes(rng.choices(b"abc", k=900))
    snippets = [base[a : a + 450] for a in rng.sample(range(400), 12)] + [bytes(rng.choices(b"abc", k=450))]
    windows, weights = np.full(13, 51), np.ones(13, dtype=int)
    right, _ = suffix_dedup.repeated_starts(snippets, windows, weights, 400)
    monkeypatch.setattr(suffix_dedup, "_CODES", np.ones(256, dtype=np.uint64))
    got, _ = suffix_dedup.repeated_starts(snippets, windows, weights, 400)
    assert (got == right).all() and right.any() and not right.all()


def test_suffix_removal_while_the_input_is_dealt_otherwise(spark, tmp_path, monkeypatch):
    """Each table written meets an input that is read in other partitions than before."""
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh ", k=500))
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randrange(50, 900))) for _ in range(160)]
    texts = [t + passage if i % 9 == 0 else t for i, t in enumerate(texts)]
    rows = [(i, t, "k", "r") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).repartition(12).write.parquet(f"{tmp_path}/in")
    written, costs = suffix_dedup.write_table, itertools.cycle((1 << 30, 1, 3000))

    def and_deal_anew(*args):
        done = written(*args)
        spark.conf.set("spark.sql.files.openCostInBytes", next(costs))
        return done

    monkeypatch.setattr(suffix_dedup, "write_table", and_deal_anew)
    try:
        found = suffix_dedup.without_repeats(
            spark.read.parquet(f"{tmp_path}/in"), "doc_id", "text", 240
        ).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r)[1:] for r in sorted(found)] == _plain_removal(texts, 240)


# -- embeddings ----------------------------------------------------------------------


@pytest.mark.parametrize("block, recall", [(16, 0.995), (1024, 0.995), (16, None), (1024, None)])
def test_vectors_link_as_all_pairs_do(spark, block, recall):
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1, 2):
        centre = rng.standard_normal((40, 32))
        rows += [(v.tolist(), label) for v in centre]
        near = centre[:10].repeat(6, axis=0)
        rows += [(v.tolist(), label) for v in near + 0.2 * rng.standard_normal(near.shape)]
    rows += [(rows[0][0], 0), (rows[0][0], 1), (rows[0][0], None), (None, 1), ([], 1),
             ([0.0] * 32, 1), ([float("nan")] * 32, 1), ([None] * 32, 1),
             ([float("inf")] * 32, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1)]
    table = [(i, v, label, "x") for i, (v, label) in enumerate(rows)]
    schema = "vec_id long, v array<float>, label int, n_links string"
    found = embedding_dedup.near_vectors(
        spark.createDataFrame(table, schema), "vec_id", "v", "label", block=block, recall=recall
    ).collect()

    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    pairs = []
    for (i, (a, x)), (j, (b, y)) in itertools.combinations(enumerate(rows), 2):
        if x is not None and x == y and usable(a) and usable(b) and len(a) == len(b):
            p, q = np.float32(a).astype(float), np.float32(b).astype(float)
            if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.93:
                pairs.append((i, j))
    links = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    roots = _union(len(rows), pairs)
    got = sorted(found, key=lambda r: r.vec_id)
    wrong = sum(r.n_links != n for r, n in zip(got, links))
    assert sum(r.n_links for r in got) >= 0.97 * links.sum() and wrong <= 0.1 * len(rows)
    assert all(r.n_links <= n for r, n in zip(got, links))
    assert wrong == 0 or recall is not None
    if wrong == 0:
        assert [r.component_id for r in got] == roots
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_vectors_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, v array<float>, label int")
    assert embedding_dedup.near_vectors(empty, "vec_id", "v", "label").count() == 0


def test_collision_count_meets_its_recall():
    n = embedding_dedup.least_collisions(64, 1.0, 0.99)
    rng = np.random.default_rng(1)
    hits = (np.abs(rng.standard_normal((20_000, 64))) <= 1.0).sum(axis=1)
    assert (hits >= n).mean() >= 0.985 and (hits >= n + 3).mean() < 0.99


def test_vectors_of_a_large_label_at_the_bound(spark):
    """10,000 vectors of one label, and 1,500 at cosines just above the bound and below it."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((10_000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.standard_normal((1_500, 64))
    aside -= (aside * base[:1_500]).sum(axis=1, keepdims=True) * base[:1_500]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = np.where(np.arange(1_500) % 3 < 2, rng.uniform(0.9301, 0.94, 1_500), rng.uniform(0.91, 0.9299, 1_500))
    mates = cosine[:, None] * base[:1_500] + np.sqrt(1 - cosine**2)[:, None] * aside
    rows = [(i, v.tolist(), "hot") for i, v in enumerate(np.vstack([base, mates]))]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, label string")
    found = embedding_dedup.near_vectors(df, "vec_id", "v", "label").where("not kept").collect()
    got = {(r.component_id, r.vec_id - 10_000) for r in found}
    want = {(i, i) for i in range(1_500) if cosine[i] >= 0.93}
    assert got <= want and len(got) >= 0.98 * len(want)


def test_vectors_without_ids_and_with_clashing_names(spark):
    schema = "vec_id long, v array<double>, label int, uid int, a int, b int, `group` int, vector int, n long"
    near, other = [1.0, 0.0], [0.0, 1.0]
    rows = [(i, v, 1, 0, 0, 0, 0, 0, 0) for i, v in
            [(None, near), (None, near), (7, other), (7, other), (3, other), (None, [-1.0, 0.0])]]
    found = embedding_dedup.near_vectors(spark.createDataFrame(rows, schema), "vec_id", "v", "label")
    assert sorted(map(repr, (tuple(r) for r in found.collect()))) == sorted(map(repr, [
        (None, 1, None, True), (None, 1, None, True), (7, 2, 3, False), (7, 2, 3, False),
        (3, 2, 3, True), (None, 0, None, True)]))


def test_windows_on_sorted_projections_count_what_lies_in_them():
    rng = np.random.default_rng(2)
    rows = rng.integers(-300, 300, (50, 64)).astype(np.int16)
    queries = rows[:7]
    want = (np.abs(queries[:, None].astype(int) - rows[None]) <= 40).sum(axis=2)
    assert (embedding_dedup._collisions(queries, rows, 40) == want).all()


def test_collisions_are_counted_in_place():
    """No list of the members of all windows is made: one count a pair, whatever they hold."""
    rng = np.random.default_rng(4)
    rows = np.rint(rng.normal(0, 1, (600, 64))).astype(np.int16)  # windows hold most rows
    rows[:200] = rows[0]
    tracemalloc.start()
    got = embedding_dedup._collisions(rows[:128], rows, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = (np.abs(rows[:128, None, :].astype(int) - rows[None, :, :]) <= 1).sum(axis=2)
    assert (got == want).all()
    assert peak < 8 * 128 * 600 * 8
