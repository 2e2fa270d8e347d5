import os
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions.clock import hours, minutes
from tidemark.functions.event_time import access_log_time, behavior_time, page_views
from tidemark.functions.parsing import parse_access_log, parse_behavior
from tidemark.operators.lateness import LatenessRule
from tidemark.operators.topn import top_n
from tidemark.plans import hot_items, hot_urls, page_views as pv
from tidemark.sources.lines import read_lines
from tidemark.streaming.batch_log import BatchLog
from tidemark.streaming.counts import stream_count
from tidemark.streaming.end_of_input import END_ACCESS_LOG_LINE, END_BEHAVIOR_LINE
from tidemark.streaming.open_state import open_windows, watermark_ms
from tidemark.streaming.run import into_all, into_log, start
from tidemark.streaming.window_state import _count_slots


def put(folder, number, lines):
    """File ``number`` of a source folder; streams take files oldest first."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"f{number:03}.txt")
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def stream(spark, folder):
    return read_lines(spark, str(folder), streaming=True, maxFilesPerTrigger=1)


def behavior_lines(seed=1, n=400):
    rng = random.Random(seed)
    times = sorted(1_704_067_200 + rng.randrange(3 * 3600) for _ in range(n))
    return [f"{rng.randrange(9)},{rng.randrange(6)},1,{rng.choice(['pv', 'pv', 'buy'])},{t}"
            for t in times]


def log_line(ms_, method, url):
    t = ms_ // 1000
    return (f"10.0.0.1 u - 01/01/2024:{t // 3600:02}:{t // 60 % 60:02}:{t % 60:02} "
            f"+0000 {method} {url}")


MIDNIGHT = 1_704_067_200_000


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def behavior_folder(tmp_path):
    folder = tmp_path / "in"
    lines = behavior_lines()
    for i in range(4):
        put(folder, i, lines[i * 100 : (i + 1) * 100])
    put(folder, 4, [END_BEHAVIOR_LINE])
    return folder


def batch_of(spark, folder):
    return parse_behavior(read_lines(spark, str(folder)))


def test_hot_items_stream_equals_batch(spark, tmp_path, behavior_folder):
    log = BatchLog(spark, str(tmp_path / "out"), hot_items.RANKED)
    source = parse_behavior(stream(spark, behavior_folder))
    hot_items.start_hot_items(source, log, str(tmp_path / "cp")).awaitTermination()
    assert rows(log.rows()) == rows(hot_items.hot_items(batch_of(spark, behavior_folder)))
    assert log.read().select("batch_id").distinct().count() > 1


def test_page_view_streams_equal_batch(spark, tmp_path, behavior_folder):
    want = rows(pv.page_view_total(batch_of(spark, behavior_folder)))
    totals = BatchLog(spark, str(tmp_path / "totals"), pv.TOTALS)
    source = parse_behavior(stream(spark, behavior_folder))
    pv.start_page_views(source, totals, str(tmp_path / "cp1")).awaitTermination()
    assert rows(totals.rows()) == want

    changes = BatchLog(spark, str(tmp_path / "changes"), pv.CHANGES)
    pv.start_page_view_changes(source, changes, str(tmp_path / "cp2")).awaitTermination()
    folded = Counter()
    for r in changes.rows().collect():
        folded[r.endtime] += r.counts if r.is_add else -r.counts
    assert sorted(folded.items()) == want


def test_restart_continues_where_it_stopped(spark, tmp_path):
    folder, lines = tmp_path / "in", behavior_lines(seed=2)
    log = BatchLog(spark, str(tmp_path / "out"), hot_items.RANKED)
    for i in range(4):
        put(folder, i, lines[i * 100 : (i + 1) * 100])
        if i == 3:
            put(folder, 4, [END_BEHAVIOR_LINE])
        source = parse_behavior(stream(spark, folder))
        hot_items.start_hot_items(source, log, str(tmp_path / "cp")).awaitTermination()
    assert rows(log.rows()) == rows(hot_items.hot_items(batch_of(spark, folder)))


def test_filtered_rows_close_windows(spark, tmp_path):
    """The last record is no page view, and yet moves the watermark."""
    folder = tmp_path / "in"
    put(folder, 0, ["1,1,1,pv,10", "1,1,1,pv,20"])
    put(folder, 1, ["1,1,1,buy,999999"])
    log = BatchLog(spark, str(tmp_path / "out"), pv.TOTALS)
    source = parse_behavior(stream(spark, folder))
    pv.start_page_views(source, log, str(tmp_path / "cp")).awaitTermination()
    assert rows(log.rows()) == [(3_600_000, 2)]


def test_filter_stays_above_the_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, 0, ["1,1,1,pv,10"])
    timed = page_views(behavior_time(parse_behavior(stream(spark, folder))))
    explain = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString
    text = explain(timed._jdf.queryExecution(), "simple")
    assert text.index("Filter") < text.index("EventTimeWatermark")
    assert "= pv" not in text[text.index("EventTimeWatermark") :]


def test_disorder_within_the_delay(spark, tmp_path):
    """Five-minute windows, one second of delay, top two; item per letter."""
    folder, code = tmp_path / "in", {"a": 1, "b": 2, "c": 3, "z": 26}
    files = [
        [(10, "a"), (20, "a"), (30, "b"), (100, "a"), (299, "c")],
        [(310, "a"), (290, "a"), (700, "b")],
        [(1300, "z")],
    ]
    for i, file in enumerate(files):
        put(folder, i, [f"1,{code[k]},1,pv,{t}" for t, k in file])
    timed = behavior_time(parse_behavior(stream(spark, folder)), delay_ms=1000)
    counts = stream_count(page_views(timed), ["item_id"], minutes(5))
    log = BatchLog(spark, str(tmp_path / "out"), hot_items.RANKED)
    again = BatchLog(spark, str(tmp_path / "again"), hot_items.RANKED)
    rank = lambda batch: top_n(batch, 2, "item_id")
    start(
        counts, into_all(into_log(log, rank), into_log(again, rank)), str(tmp_path / "cp")
    ).awaitTermination()
    assert rows(log.rows()) == [
        (300_000, 1, 1, 4),
        (300_000, 2, 2, 1),
        (600_000, 1, 1, 1),
        (900_000, 1, 2, 1),
    ]
    assert rows(again.rows()) == rows(log.rows())


def test_hot_urls_stream_equals_batch(spark, tmp_path):
    rng, folder = random.Random(4), tmp_path / "in"
    times = sorted(rng.randrange(0, 900) for _ in range(150))
    lines = [log_line(t * 1000, rng.choice(["GET", "GET", "POST"]), f"/p/{rng.randrange(7)}")
             for t in times]
    for i in range(3):
        put(folder, i, lines[i * 50 : (i + 1) * 50])
    put(folder, 3, [END_ACCESS_LOG_LINE])
    log = BatchLog(spark, str(tmp_path / "out"), hot_urls.RANKED)
    source = parse_access_log(stream(spark, folder))
    hot_urls.start_hot_urls(source, log, str(tmp_path / "cp")).awaitTermination()
    assert rows(log.rows()) == rows(
        hot_urls.hot_urls(parse_access_log(read_lines(spark, str(folder))))
    )


def literal_batches(batches, rule, n):
    """Lateness with one watermark per micro-batch, taken literally."""
    newest, counts, late, ranked = None, defaultdict(Counter), [], {}
    for batch in batches:
        wm = None if newest is None else newest - rule.delay
        touched = set()
        for ms_, method, url in batch:
            first = ms_ // rule.slide * rule.slide + rule.slide
            ends = range(first, first + rule.size, rule.slide)
            if method != "GET":
                continue
            if wm is not None and ends[-1] - 1 + rule.lateness <= wm:
                late.append((ms_, url))
            for end in ends:
                if wm is None or end - 1 + rule.lateness > wm:
                    counts[end][url] += 1
                    touched.add(end)
        newest = max([m for m, _, _ in batch] + ([] if newest is None else [newest]))
        now = newest - rule.delay
        fired = {}
        for end, urls in counts.items():
            closed_before = wm is not None and end - 1 <= wm
            if end - 1 <= now and (not closed_before or end in touched):
                best = sorted(urls.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
                fired[end] = [(i + 1, u, c) for i, (u, c) in enumerate(best)]
        ranked.update({(len(ranked), end): r for end, r in fired.items()})
        yield fired, list(late)


RULE = {"size": minutes(2), "slide": 10_000, "delay": 1_000, "lateness": 60_000}


def late_batches():
    """Files of disordered requests."""
    rng, now, batches = random.Random(9), 0, []
    for _ in range(6):
        batch = []
        for _ in range(30):
            now += rng.randrange(0, 6_000)
            back = rng.choice([0, 0, 0, 30_000, 100_000, 400_000])
            when = max(0, now - rng.randrange(back + 1)) // 1000 * 1000
            batch.append((when, rng.choice(["GET", "GET", "HEAD"]), f"/p/{rng.randrange(8)}"))
        batches.append(batch)
    return batches


def late_job(spark, tmp_path, folder):
    source = parse_access_log(stream(spark, folder))
    schema = access_log_time(source).schema
    job = hot_urls.late_job(spark, str(tmp_path / "out"), schema, n=3, **RULE)
    hot_urls.start_hot_urls_late(source, job, str(tmp_path / "cp")).awaitTermination()
    return job


@pytest.mark.parametrize("restarts", [False, True])
def test_late_stream_fires_revises_and_sets_aside(spark, tmp_path, restarts):
    """All at once, or with a new job on the old checkpoint after each file."""
    rule, folder = LatenessRule(**RULE), tmp_path / "in"
    batches = late_batches()
    for i, batch in enumerate(batches):
        put(folder, i, [log_line(*row) for row in batch])
        if restarts:
            late_job(spark, tmp_path, folder)
    put(folder, len(batches), [END_ACCESS_LOG_LINE])
    batches.append([(10**13, "__end__", "-")])
    job = late_job(spark, tmp_path, folder)

    got = defaultdict(lambda: defaultdict(list))
    for r in job.firings().orderBy("version", "window_end", "rk").collect():
        got[r.window_end - MIDNIGHT][r.version].append((r.rk, r.url, r["count"]))
    fired = list(literal_batches(batches, rule, 3))
    versions = defaultdict(list)
    for want, _ in fired:
        for end, ranking in want.items():
            versions[end].append(ranking)
    assert {end: [v[k] for k in sorted(v)] for end, v in got.items()} == versions
    assert max(map(len, versions.values())) > 1
    want_late = fired[-1][1]
    got_late = [(r.event_time - MIDNIGHT, r.url) for r in job.late.rows().collect()]
    assert want_late and sorted(got_late) == sorted(want_late)

    final = {}
    for want, _ in fired:
        final.update(want)
    current = defaultdict(list)
    for r in job.current().orderBy("window_end", "rk").collect():
        current[r.window_end - MIDNIGHT].append((r.rk, r.url, r["count"]))
    assert dict(current) == final


def test_state_ends_with_its_windows(spark, tmp_path):
    """Nothing is held for keys whose windows have all passed; what is held stays small."""
    folder = tmp_path / "in"
    rule = {"size": 20_000, "slide": 10_000, "delay": 1_000, "lateness": 10_000}
    sizes = []
    for i in range(8):
        put(folder, i, [log_line(i * 30_000 + k * 100, "GET", f"/{i}/{k % 3}") for k in range(6)])
        source = parse_access_log(stream(spark, folder))
        job = hot_urls.late_job(spark, str(tmp_path / "out"), access_log_time(source).schema, **rule)
        query = hot_urls.start_hot_urls_late(source, job, str(tmp_path / "cp"))
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]
        sizes.append(state["numRowsTotal"])
    assert max(sizes) <= 3 * 3 * 2 and sizes[-1] <= sizes[2]
    # Every closed window's final ranking counts all its records.
    totals = job.current().groupBy("window_end").agg(F.sum("count").alias("n")).collect()
    assert len(totals) >= 12 and {r.n for r in totals} == {6}


def test_open_windows_are_read_from_the_state(spark, tmp_path):
    """What a stopped stream holds are the windows its watermark has not passed."""
    folder, rng = tmp_path / "in", random.Random(7)
    sent = sorted((rng.randrange(0, 600) * 1000, f"/p/{rng.randrange(4)}") for _ in range(120))
    for i in range(3):
        put(folder, i, [log_line(ms_, "GET", url) for ms_, url in sent[i * 40 : (i + 1) * 40]])
    source = parse_access_log(stream(spark, folder))
    job = hot_urls.late_job(spark, str(tmp_path / "out"), access_log_time(source).schema, **RULE)
    query = hot_urls.start_hot_urls_late(source, job, str(tmp_path / "cp"))
    query.awaitTermination()
    passed = watermark_ms(query)
    assert passed == MIDNIGHT + sent[-1][0] - RULE["delay"] - RULE["lateness"]
    want = Counter()
    for ms_, url in sent:
        first = MIDNIGHT + ms_ // RULE["slide"] * RULE["slide"] + RULE["slide"]
        for end in range(first, first + RULE["size"], RULE["slide"]):
            if end - 1 > passed:
                want[end, url] += 1
    found = open_windows(spark, str(tmp_path / "cp"), "url string", RULE["size"], RULE["slide"], passed)
    assert {(r.window_end, r.url): r["count"] for r in found.collect()} == want and want


def test_a_hot_key_is_counted_before_it_is_shuffled(spark, tmp_path):
    """One row per slot and Arrow batch reaches the keyed state; no window copies do."""
    folder = tmp_path / "in"
    put(folder, 0, [f"1,7,1,pv,{10 + i % 3}" for i in range(5000)])
    put(folder, 1, [END_BEHAVIOR_LINE])
    counts = stream_count(
        page_views(behavior_time(parse_behavior(stream(spark, folder)))), ["item_id"], hours(1), minutes(5)
    )
    log = BatchLog(spark, str(tmp_path / "out"), counts.schema)
    query = start(counts, into_log(log, lambda batch: batch), str(tmp_path / "cp"))
    query.awaitTermination()
    text = query._jsq.explainInternal(False)
    before_state = text[text.index("TransformWithState") :]
    assert "Exchange" in before_state and "Expand" not in before_state and "Generate" not in before_state
    assert rows(log.rows()) == [(end * 300_000, 7, 5000) for end in range(1, 13)]
    state = [p["stateOperators"][0] for p in query.recentProgress]
    assert max(p["numRowsUpdated"] for p in state) <= 3


def test_a_key_reaches_its_state_in_one_row():
    """All slots of a key in an Arrow batch: keyed state is visited per row."""
    batch = pa.RecordBatch.from_pydict(
        {"group": ["a", "b", "a", "a", "a"], "slot": [5, 5, 10, 5, 15]}
    )
    (counted,) = _count_slots(iter([batch]))
    found = {r["group"]: sorted(zip(r["slots"], r["counted"])) for r in counted.to_pylist()}
    assert counted.num_rows == 2
    assert found == {"a": [(5, 2), (10, 1), (15, 1)], "b": [(5, 1)]}


def test_the_file_of_a_micro_batch_can_be_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(entry, "new_folder", lambda spark, purpose: str(tmp_path / purpose))
    rows = spark.range(0, 400_000, 1, 1).select(
        F.col("id").alias("event_id"), F.timestamp_millis(F.hash("id").cast("long")).alias("ts"),
        F.xxhash64("id").alias("user_id"), F.lit("view").alias("event_type"),
        F.rand(1).alias("value"), F.lit("{}").alias("props"),
    ).withColumn("ts", F.to_timestamp_ntz("ts"))
    entry._as_stream(spark, rows)
    (path,) = (tmp_path / "arrived" / "events.parquet").glob("part-*.parquet")
    assert pq.ParquetFile(path).num_row_groups >= 4


STREAMS = {
    "hot_items_stream": "hot_items_topn",
    "hot_urls_stream": "hot_urls_topn",
    "hot_urls_table_stream": "topn_rank_max",
    "hot_urls_late_stream": "hot_urls_topn",
    "pv_changes_stream": "pv_table_total",
    "pv_report_stream": "pv_report",
    "hot_items_report_stream": "hot_items_report",
}


@pytest.mark.parametrize("name", STREAMS)
def test_streams_of_several_batches_equal_batch(spark, name):
    import __spark_entry__ as entry

    queries = entry.queries()
    got = queries[name](spark, entry.SMOKE_DIR)
    want = queries[STREAMS[name]](spark, entry.SMOKE_DIR)
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == want.count() > 0


def test_hourly_stream_from_events_table(spark):
    import __spark_entry__ as entry

    got = entry.pv_stream(spark, entry.SMOKE_DIR)
    want = entry.pv_plain_total(spark, entry.SMOKE_DIR)
    assert rows(got.select("window_end", "count")) == rows(want.select("window_end", "count"))
    assert got.agg(F.sum("count")).first()[0] > 0 and hours(1) == 3_600_000
