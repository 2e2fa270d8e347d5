import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.operators import changelog, lateness
from tidemark.operators.lateness import LatenessRule
from tidemark.plans import hot_urls

RULES = [
    LatenessRule(),
    LatenessRule(size=60_000, slide=20_000, delay=0, lateness=0),
    LatenessRule(size=60_000, slide=5_000, delay=7_500, lateness=12_000),
    LatenessRule(size=10_000, slide=10_000, delay=90_000, lateness=3_000),
]


def replay(rows, rule):
    """The rule taken literally: one pass in arrival order."""
    newest, classes, late = None, defaultdict(Counter), []
    for position, ms, key in sorted(rows):
        wm = None if newest is None else newest - rule.delay
        first = ms // rule.slide * rule.slide + rule.slide
        ends = range(first, first + rule.size, rule.slide)
        for end in ends:
            if wm is None or wm < end - 1:
                kind = "on_time"
            elif wm < end - 1 + rule.lateness:
                kind = "accepted_late"
            else:
                kind = "dropped"
            classes[end, key][kind] += 1
        if wm is not None and ends[-1] - 1 + rule.lateness <= wm:
            late.append(position)
        newest = ms if newest is None else max(newest, ms)
    return classes, late


def frame(spark, rows):
    return spark.createDataFrame(rows, "position long, event_ms long, url string").withColumn(
        "position", F.col("position").cast("decimal(38,0)")
    )


def disordered(rule, seed, n=300, gap=False):
    rng = random.Random(seed)
    rows, now = [], -3 * rule.size
    for i in range(n):
        now += rng.randrange(0, rule.slide * 3)
        if gap and i in (100, 200):
            now += 40 * rule.block  # leaves blocks without any row
        lost = rule.delay + rule.lateness + rule.size + 6 * rule.slide
        near = rule.delay + rule.lateness + rule.slide
        back = rng.choice([0, 0, rng.randrange(near), rng.randrange(rule.delay, near),
                           rng.randrange(lost), lost])
        rows.append((i, now - back, rng.choice("aab")))
    return rows


@pytest.mark.parametrize("rule", RULES)
@pytest.mark.parametrize("gap", [False, True])
def test_equals_literal_replay(spark, rule, gap):
    rows = disordered(rule, seed=rule.size, gap=gap)
    classes, late = replay(rows, rule)
    df = frame(spark, rows)
    gates = lateness.build_gates(df, rule)
    assert sorted(int(r.position) for r in lateness.late_output(df, gates).collect()) == late
    got = {
        (r.window_end, r.url): Counter(
            {k: r[k] for k in ("on_time", "accepted_late", "dropped") if r[k]}
        )
        for r in lateness.class_counts(df, ["url"], gates).collect()
    }
    assert got == dict(classes)
    assert late and any(c["accepted_late"] for c in classes.values()) == bool(rule.lateness)


def test_shuffled_gates_give_the_same(spark, monkeypatch):
    rule = RULES[2]
    rows = disordered(rule, seed=3)
    df = frame(spark, rows)
    monkeypatch.setattr(workspace, "BROADCAST_BYTES", 0)
    gates = lateness.build_gates(df, rule)
    assert not gates.broadcastable
    got = sorted(int(r.position) for r in lateness.late_output(df, gates).collect())
    assert got == replay(rows, rule)[1]


@pytest.mark.parametrize(
    "offset,kind",
    [(-2, "on_time"), (-1, "accepted_late"), (59_998, "accepted_late"), (59_999, "dropped")],
)
def test_class_borders(spark, offset, kind):
    """A row of the window ending at 10 s, at a watermark of 10 s + offset."""
    rule = LatenessRule(size=5_000, slide=5_000)
    rows = [(0, 10_000 + offset + rule.delay, "x"), (1, 7_000, "a")]
    df = frame(spark, rows)
    counts = lateness.class_counts(df, ["url"], lateness.build_gates(df, rule))
    row = counts.where("url = 'a'").first()
    assert row.window_end == 10_000 and row[kind] == 1
    assert row.on_time + row.accepted_late + row.dropped == 1


def test_filtered_rows_move_the_watermark(spark):
    rows = [(0, 1_000, "GET"), (1, 2_000_000, "POST"), (2, 1_500, "GET")]
    log = frame(spark, rows).withColumnRenamed("url", "method").withColumn("url", F.lit("/p"))
    late = hot_urls.too_late(log, hot_urls.replay(log)).collect()
    assert [int(r.position) for r in late] == [2]


def test_rankings_before_and_after_late_rows(spark):
    rule = LatenessRule()
    rows = disordered(rule, seed=11, n=200)
    classes, _ = replay(rows, rule)
    log = frame(spark, rows).withColumn("method", F.lit("GET"))
    history = hot_urls.ranking_history(log, hot_urls.replay(log)).collect()

    def ranking(kinds):
        counts = {k: sum(c[x] for x in kinds) for k, c in classes.items()}
        ranks = defaultdict(list)
        for (end, url), n in counts.items():
            if n:
                ranks[end].append((-n, url))
        return {
            (end, i + 1, url, -n)
            for end, keys in ranks.items()
            for i, (n, url) in enumerate(sorted(keys)[:5])
        }

    pick = lambda v: {tuple(r)[:4] for r in history if r.version == v}
    final = ranking(["on_time", "accepted_late"])
    changed = {end for (end, _), c in classes.items() if c["accepted_late"]}
    assert pick(1) == ranking(["on_time"])
    assert pick(2) == {row for row in final if row[0] in changed}
    current = hot_urls.current_ranking(spark.createDataFrame(history))
    assert {tuple(r) for r in current.collect()} == final


def test_positions_order_by_arrival_then_tie(spark):
    df = spark.createDataFrame(
        [(5, 2**62), (6, 0), (5, 1), (1_704_067_200_000, 3)], "arrival long, tie long"
    )
    p = lateness.arrival_position(F.col("arrival"), F.col("tie"))
    assert [tuple(r) for r in df.orderBy(p).collect()] == [
        (5, 1), (5, 2**62), (6, 0), (1_704_067_200_000, 3),
    ]


def test_the_gates_end_at_the_search(spark, plan):
    df = frame(spark, [(0, 1, "a"), (9_000, 2, "b")])
    gates = lateness.build_gates(df, LatenessRule())
    lines = plan(lateness.class_steps(df, ["url"], gates)).splitlines()
    search = next(i for i, line in enumerate(lines) if "Generate explode(array(_gates" in line)
    assert not any("_gates" in line for line in lines[:search])
    # Edges are summed per task before they are dealt out.
    assert sum("Exchange" in line and "_chunk" in line for line in lines[:search]) == 2


def test_gates_plan(spark, plan):
    """First positions are partial minima in hash tables, over no global order."""
    df = frame(spark, [(0, 1, "a")])
    slot = df.groupBy("event_ms").agg(F.min("position"))
    assert "HashAggregate" in plan(slot) and "SortAggregate" not in plan(slot)
    with pytest.raises(ValueError):
        LatenessRule(size=7, slide=5)


def test_retract_rows(spark):
    partials = spark.createDataFrame(
        [(10, "pv0", 3), (10, "pv1", 4), (10, "pv2", 5), (20, "pv0", 1)],
        "window_end long, salt string, count long",
    )
    rows = changelog.to_retract(changelog.running_totals(partials, "salt"))
    got = [tuple(r) for r in rows.orderBy("window_end", "seq").collect()]
    assert got == [
        (True, 3, 10, 1),
        (False, 3, 10, 2),
        (True, 7, 10, 3),
        (False, 7, 10, 4),
        (True, 12, 10, 5),
        (True, 1, 20, 1),
    ]
    current = changelog.latest(rows, ["window_end"], "seq", is_add="is_add")
    assert sorted(tuple(r) for r in current.collect()) == [(10, 12), (20, 1)]


def test_latest_never_mixes_revisions_and_drops_retracted(spark):
    history = spark.createDataFrame(
        [(1, 1, "z", 1, 1, True), (1, 1, "a", 9, 2, True), (1, 2, "b", 1, 3, False)],
        "endtime1 long, rk int, url string, counts long, version int, is_add boolean",
    )
    got = changelog.latest(history, ["endtime1", "rk"], "version", is_add="is_add")
    assert [tuple(r) for r in got.collect()] == [(1, 1, "a", 9)]


def test_ranking_changes_fold_back_at_every_version(spark):
    rng = random.Random(12)
    history = []
    for window in range(12):
        for version in range(1, rng.randrange(2, 6)):
            size = rng.randrange(1, 5)
            history += [(window, version, rk, rng.choice("ab"), rng.randrange(3)) for rk in range(1, size + 1)]
    df = spark.createDataFrame(history, "window_end long, version int, rk int, url string, count long")
    changes = [
        (r.seq, r.window_end, r.rk, r.is_add, (r.url, r["count"]))
        for r in changelog.ranking_changes(df, ["url", "count"]).collect()
    ]
    assert any(not c[3] for c in changes)
    table, versions = {}, {}
    for window, version, rk, url, count in history:
        versions.setdefault((window, version), {})[rk] = (url, count)
    for version in range(1, 6):
        for seq, window, rk, is_add, value in sorted(c for c in changes if c[0] // 2 == version):
            if is_add:
                assert (window, rk) not in table
                table[window, rk] = value
            else:
                assert table.pop((window, rk)) == value
        for window in range(12):
            if (window, version) in versions:
                assert {rk: v for (w, rk), v in table.items() if w == window} == versions[window, version]
    # What stays as it is gives no rows.
    same = spark.createDataFrame([(1, v, 1, "a", 5) for v in (1, 2, 3)], df.schema)
    assert changelog.ranking_changes(same, ["url", "count"]).count() == 1


def test_ranking_changes_of_nothing(spark):
    empty = spark.createDataFrame([], "window_end long, version int, rk int, url string, count long")
    assert changelog.ranking_changes(empty, ["url", "count"]).count() == 0
