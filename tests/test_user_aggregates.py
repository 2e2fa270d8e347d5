"""Aggregates written by users, against plain Python."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.compute as pc

from tidemark.operators.user_aggregate import (
    Aggregate,
    Count,
    TopCounts,
    aggregate_by,
    partial_buffers,
)

SCHEMA = "window_end long, kind string, url string, count long"


def _rows(seed, n):
    rng = random.Random(seed)
    return [
        (rng.choice([1, 1, 1, 2, None]), rng.choice(["a", "b", None]), f"/{rng.randrange(40)}", rng.randrange(90))
        for _ in range(n)
    ]


def test_top_counts_equal_brute_force(spark):
    rows = _rows(1, 3000) + [(9, "a", "/x", 5), (9, "a", "/w", 5), (9, "a", "/x", 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = aggregate_by(df, ["window_end", "kind"], TopCounts(5, "url", "count")).collect()
    best = defaultdict(dict)
    for end, kind, url, count in rows:
        own = best[end, kind]
        own[url] = max(count, own.get(url, 0))
    want = {
        (*group, i, url, count)
        for group, own in best.items()
        for i, (url, count) in enumerate(sorted(own.items(), key=lambda kv: (-kv[1], kv[0]))[:5], 1)
    }
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_counts_equal_brute_force(spark):
    rows = _rows(2, 2000)
    found = aggregate_by(spark.createDataFrame(rows, SCHEMA), ["window_end", "kind"], Count("n")).collect()
    assert {(r.window_end, r.kind): r.n for r in found} == Counter(r[:2] for r in rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert aggregate_by(empty, ["kind"], Count()).count() == 0


def test_a_hot_group_arrives_merged(spark):
    hot = spark.range(0, 200_000, 1, 4).selectExpr(
        "1L AS window_end", "concat('/', id % 1000) AS url", "id AS count"
    )
    parts = partial_buffers(hot, ["window_end"], TopCounts(5, "url", "count"))
    assert parts.count() == 4 * 5


class Spread(Aggregate):
    """A user's own: the range of a group's counts, and nothing where there is none."""

    buffer = "low long, high long"
    result = "width long"

    def add(self, rows, groups):
        return self._joined(rows.group_by(groups).aggregate([("count", "min"), ("count", "max")]),
                            groups, "count_min", "count_max")

    def merge(self, buffers, groups):
        return self._joined(buffers.group_by(groups).aggregate([("low", "min"), ("high", "max")]),
                            groups, "low_min", "high_max")

    def _joined(self, table, groups, low, high):
        return table.select([*groups, low, high]).rename_columns([*groups, "low", "high"])

    def emit(self, buffers, groups):
        width = pa.array([h - a for a, h in zip(*(buffers[c].to_pylist() for c in ("low", "high")))], pa.int64())
        table = buffers.append_column("width", width)
        return table.filter(pc.greater(table["width"], 0))


def test_an_aggregate_of_ones_own(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    rows = _rows(3, 500) + [(77, "z", "/", 4)]
    found = aggregate_by(spark.createDataFrame(rows, SCHEMA).repartition(5), ["window_end"], Spread()).collect()
    counts = defaultdict(list)
    for end, _, _, count in rows:
        counts[end].append(count)
    assert {r.window_end: r.width for r in found} == {
        e: max(c) - min(c) for e, c in counts.items() if max(c) > min(c)}
