import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.functions.clock import hours, minutes, seconds
from tidemark.functions.salts import hashed_salt, numbered_salt, random_salt
from tidemark.operators import topn, totals, windows
from tidemark.operators.upkeep import WindowTable
from tidemark.operators.windows import in_blocks, sliding_count, tumbling_count, window_ends


def events(spark, rows):
    df = spark.createDataFrame(rows, "ms long, key string")
    return df.withColumn("ts", F.timestamp_millis("ms"))


def as_dict(counts, *keys):
    return {tuple(r[k] for k in ("window_end", *keys)): r["count"] for r in counts.collect()}


def brute(rows, size, slide):
    """Count by copying every row into each of its windows."""
    counts = Counter()
    for ms, key in rows:
        start = (ms // slide) * slide
        while start > ms - size:
            counts[start + size, key] += 1
            start -= slide
    return dict(counts)


@pytest.mark.parametrize(
    "size,slide",
    [
        (minutes(10), seconds(5)),
        (hours(1), minutes(5)),
        (minutes(5), minutes(5)),
        (seconds(7), seconds(3)),  # no multiple: the direct form
        (seconds(6), seconds(3)),
    ],
)
def test_sliding_equals_brute_force(spark, size, slide):
    rng = random.Random(5)
    # Long spans cross chunk borders; negative times lie before 1970.
    span = size * 70
    rows = [(rng.randrange(-span, span), rng.choice("aaaaaabcd")) for _ in range(300)]
    rows += [(0, "a"), (slide, "a"), (slide - 1, "a"), (-1, "b"), (0, "a")]
    rows += [(size * 32, "a"), (size * 32 - 1, "a"), (-size * 32, "c")]
    got = as_dict(sliding_count(events(spark, rows), ["key"], size, slide), "key")
    assert got == brute(rows, size, slide)


def test_sliding_without_keys(spark):
    rows = [(1, "a"), (5000, "b"), (700000, "c")]
    got = as_dict(sliding_count(events(spark, rows), [], minutes(10), seconds(5)))
    want = Counter()
    for (end, _), n in brute(rows, minutes(10), seconds(5)).items():
        want[(end,)] += n
    assert got == dict(want)


def test_each_row_counts_in_every_window_once(spark):
    rows = [(i * 777, f"k{i % 7}") for i in range(500)]
    df = events(spark, rows)
    for size, slide in [(hours(1), minutes(5)), (minutes(10), seconds(5))]:
        total = sliding_count(df, ["key"], size, slide).agg(F.sum("count")).first()[0]
        assert total == len(rows) * size // slide


def test_counted_column_skips_nulls_but_keeps_the_group(spark):
    df = events(spark, [(1, None), (2, "a"), (3, "a")])
    got = tumbling_count(df, ["key"], 1000, counted="key").collect()
    assert {(r["key"], r["count"]) for r in got} == {(None, 0), ("a", 2)}
    got = sliding_count(df, ["key"], 2000, 1000, counted="key").collect()
    assert {(r["window_end"], r["key"], r["count"]) for r in got} == {
        (1000, None, 0), (2000, None, 0), (1000, "a", 2), (2000, "a", 2),
    }


def test_window_edge(spark):
    df = events(spark, [(3_600_000, "a"), (3_599_000, "a")])
    assert as_dict(tumbling_count(df, [], hours(1))) == {(7_200_000,): 1, (3_600_000,): 1}


@pytest.mark.parametrize("n", [1, 8, 64])
def test_salted_equals_plain(spark, n):
    df = events(spark, [(i * 9973, "hot") for i in range(2000)])
    plain = as_dict(totals.plain_total(df, hours(1)))
    assert sum(plain.values()) == 2000
    for salt in (
        None,
        random_salt("pv_", n),
        hashed_salt("pv_", "ms", n=n),
        numbered_salt("pv_", F.col("ms"), n),
    ):
        assert as_dict(totals.salted_total(df, hours(1), salt=salt)) == plain


def test_salt_forms(spark):
    df = spark.range(1000).withColumn("b", F.lit("pv"))
    underscored = {r[0] for r in df.select(random_salt("pv_")).distinct().collect()}
    appended = {r[0] for r in df.select(random_salt(F.col("b"))).distinct().collect()}
    assert underscored == {f"pv_{i}" for i in range(8)}
    assert appended == {f"pv{i}" for i in range(8)}


def test_top_n_ties_and_short_windows(spark):
    counts = spark.createDataFrame(
        [(10, 2, 5), (10, 1, 5), (10, 3, 9), (10, 4, 1), (20, 7, 1)],
        "window_end long, item_id long, count long",
    )
    got = topn.top_n(counts, 3, "item_id").orderBy("window_end", "rk").collect()
    assert got == [(10, 1, 3, 9), (10, 2, 1, 5), (10, 3, 2, 5), (20, 1, 7, 1)]
    everything = topn.top_n(counts, 50, "item_id")
    assert [r.rk for r in everything.where("window_end = 10").collect()] == [1, 2, 3, 4]


def test_top_n_of_max_keeps_the_largest_count(spark):
    history = spark.createDataFrame(
        [(10, "a", 3), (10, "a", 5), (10, "b", 4), (10, "b", 4), (10, "a", 1)],
        "window_end long, url string, count long",
    )
    got = topn.as_table_rows(topn.top_n_of_max(history, 5, "url"), "url")
    assert got.orderBy("rk").collect() == [(10, 1, "a", 5), (10, 2, "b", 4)]
    assert topn.max_per_rank(got).orderBy("rk").collect() == [(10, 1, "a", 5), (10, 2, "b", 4)]


@pytest.mark.parametrize("n", [1, 3, 40])
@pytest.mark.parametrize(
    "size,slide",
    [(minutes(10), seconds(5)), (seconds(9), seconds(9)),
     (seconds(7), seconds(3))],
)
def test_sliding_top_n_is_exact(spark, monkeypatch, n, size, slide):
    """A few hot keys, a long tail, ties, a gap; with and without broadcast."""
    rng = random.Random(n)
    span = size * 40
    keys = ["hot"] * 30 + ["warm"] * 10 + ["w2"] * 10 + [f"t{i}" for i in range(30)]
    rows = [(rng.randrange(-span, span // 3), rng.choice(keys)) for _ in range(1500)]
    rows += [(span + size * 50 + rng.randrange(size), rng.choice(keys)) for _ in range(60)]
    df = events(spark, rows)
    ends = {}
    for (end, key), c in brute(rows, size, slide).items():
        ends.setdefault(end, []).append((-c, key))
    want = sorted(
        (end, i + 1, key, -c)
        for end, ranked in ends.items()
        for i, (c, key) in enumerate(sorted(ranked)[:n])
    )
    got = topn.sliding_top_n(df, n, "key", size, slide)
    assert sorted(tuple(r) for r in got.collect()) == want
    if n == 3:
        monkeypatch.setattr(workspace, "BROADCAST_BYTES", 0)
        got = topn.sliding_top_n(df, n, "key", size, slide)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_sliding_plan(spark, plan):
    """Slots are pre-aggregated; the window copies are never shuffled."""
    df = events(spark, [(1, "a")])
    text = plan(topn.top_n(sliding_count(df, ["key"], minutes(10), seconds(5)), 5, "key"))
    assert text.count("Exchange") == 3
    top, below = text.split("Generate explode(sequence(_at", 1)
    assert top.count("Exchange") == 1 and below.count("Exchange") == 2
    assert "partial_count(1)" in below
    assert top.count("WindowGroupLimit") == 2
    assert "Partial" in top.split("Exchange")[1]
    assert "Python" not in text and "CartesianProduct" not in text


def test_count_plan_reads_two_columns(spark, plan):
    import __spark_entry__ as entry

    text = plan(entry.pv_plain_total(spark, entry.SMOKE_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    assert "partial_count(1)" in text
    assert "In(event_type, [pv,view])" in text or "In(event_type, [view,pv])" in text


def _skewed(spark):
    """A third of all rows on one key, a tenth on the null key, the rest thin."""
    rows = []
    for i in range(6000):
        kind = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{i}"
        rows.append((kind, i * 700))
    return spark.createDataFrame(rows, "key string, ms long").select(
        "key", F.timestamp_millis("ms").alias("ts")
    )


def test_only_hot_keys_are_salted(spark):
    df = _skewed(spark)
    hot = totals.hot_keys(df, "key", 0.05)
    assert sorted(map(str, hot)) == ["None", "hot"]
    salted = df.select("key", totals.hot_salted(df, "key", hot, hashed_salt("", "ts")).alias("salt"))
    salts = {r.key: r.n for r in salted.groupBy("key").agg(F.countDistinct("salt").alias("n")).collect()}
    assert salts["hot"] == salts[None] == 8 and {n for k, n in salts.items() if k not in ("hot", None)} == {0}


@pytest.mark.parametrize("share", [0.001, 0.05, 0.9])
def test_hot_salted_counts_equal_plain_counts(spark, share):
    df = _skewed(spark)
    got = totals.hot_salted_count(df, "key", 60_000, share=share)
    want = tumbling_count(df, ["key"], 60_000)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert totals.hot_salted_count(df.limit(0), "key", 60_000).count() == 0


def _parts(path):
    return {
        os.path.relpath(os.path.join(at, f), path): os.stat(os.path.join(at, f)).st_mtime_ns
        for at, _, files in os.walk(path) for f in files if f.endswith(".parquet")
    }


def test_a_load_computes_only_the_days_it_touches(spark, tmp_path):
    rng = random.Random(3)
    size, slide, day = hours(1), minutes(10), 86_400_000
    rows = [(rng.randrange(10 * day), f"k{rng.randrange(3)}") for _ in range(600)]
    rows += [(4 * day - 1, "edge"), (4 * day, "edge")]
    table = WindowTable(spark, str(tmp_path), "key string", size, slide)
    assert table.windows().count() == 0
    first = [r for r in rows if not 3.2 * day < r[0] < 3.6 * day]
    later = [r for r in rows if r not in first]
    assert set(range(10)) <= set(table.add(events(spark, first), "a"))
    before = _parts(f"{tmp_path}/windows")
    assert table.add(events(spark, later), "b") == [3]
    changed = {p for p, t in _parts(f"{tmp_path}/windows").items() if before.get(p) != t}
    assert changed and all(p.startswith("day=3/") for p in changed)
    plan = table.slots_of([3])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"day#\d+ IN \(2,3\)", plan.split("PartitionFilters: [")[1].split("]")[0])
    days = table.slots_of([3]).select("day").distinct().collect()
    assert {r.day for r in days} == {2, 3}
    want = as_dict(sliding_count(events(spark, rows), ["key"], size, slide), "key")
    assert as_dict(table.windows(), "key") == want
    # The same load again, and an empty one, change nothing.
    table.add(events(spark, later), "b")
    assert table.add(events(spark, later).limit(0), "c") == []
    assert as_dict(table.windows(), "key") == want
    assert {r.window_end // day for r in table.windows([3]).collect()} == {3}


def test_scratch_leaves_no_file(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry

    def files():
        return [f for _, _, found in os.walk(tmp_path) for f in found]

    monkeypatch.setattr(workspace, "shared_root", lambda _: str(tmp_path))
    for name in ("hot_items_topn", "window_upkeep", "pv_stream", "hot_items_report_text"):
        with workspace.scratch(spark):
            assert entry.queries()[name](spark, entry.SMOKE_DIR).count() > 0
            assert files()
        assert not files(), name


def test_ranked_windows_of_a_task_are_bounded(spark, monkeypatch):
    """Few stretches hold many windows: tasks follow the windows, and rank as one would."""
    monkeypatch.setattr(windows, "TASK_ROWS", 2_000)
    monkeypatch.setattr(windows, "_DEAL_ROWS", 500)
    rng = random.Random(3)
    rows = [(f"k{i % 40}", s := 5 * rng.randrange(-300, 900), s + 5 * rng.randrange(1, 700),
             rng.randrange(6)) for i in range(120)]
    rows.append((None, -1_500, 6_000, 4))
    steps = spark.createDataFrame(rows, "key string, _at long, _next long, n long")
    # Stretches of a key do not overlap.
    steps = steps.groupBy("key").agg(*[F.max_by(c, "_at").alias(c) for c in ("_at", "_next", "n")])
    blocks = in_blocks(steps, "key", 5)
    written = window_ends(blocks.table, ["_block", "key"], ["n"], 5)
    assert written.count() == window_ends(steps, ["key"], ["n"], 5).count() == blocks.windows
    per_task = written.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task <= 2 * windows.TASK_ROWS < blocks.windows
    got = topn.top_n_in_blocks(blocks, 3, "key", F.col("n")).collect()
    whole = window_ends(steps.where("n > 0").withColumnRenamed("n", "count"), ["key"], ["count"], 5)
    assert got and sorted(got) == sorted(topn.top_n(whole, 3, "key").collect())


def test_more_intervals_go_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(windows, "TASK_ROWS", 10)
    rows = [("a", 5 * i, 5 * i + 50, 1) for i in range(60)]
    intervals = spark.createDataFrame(rows, "key string, _start long, _stop long, n long")
    steps = windows.interval_steps(intervals, ["key"], ["n"], 50, 5, present="n", rows=60)
    assert steps.rdd.getNumPartitions() == 12
    plain = windows.interval_steps(intervals, ["key"], ["n"], 50, 5, present="n")
    assert sorted(steps.collect()) == sorted(plain.collect())


def test_hopeless_stretches_are_left_out(spark):
    """Ties and null keys included: what is left ranks as all stretches would."""
    rng = random.Random(8)
    rows = []
    for key in [None, *[f"k{i:02}" for i in range(60)]]:
        at = 5 * rng.randrange(-200, 50)
        for _ in range(6):
            end = at + 5 * rng.randrange(1, 90)
            rows.append((key, at, end, rng.choice([1, 1, 1, 2, 3])))
            at = end + 5 * rng.randrange(0, 20)
    steps = spark.createDataFrame(rows, "key string, _at long, _next long, count long")
    ranked = lambda s: topn.top_n(window_ends(s, ["key"], ["count"], 5), 3, "key")
    for span in (None, 10_000):
        some = topn.hopeful_stretches(steps, 3, "key", 5, span=span)
        assert sorted(ranked(some).collect()) == sorted(ranked(steps).collect())
    windows_of = lambda s: window_ends(s, ["key"], ["count"], 5).count()
    assert windows_of(some) < windows_of(steps) / 2
