import dataclasses
import os
import sqlite3

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.functions import reports
from tidemark.schemas import UPSERT_ROW
from tidemark.sinks.ordered_text import (
    files_in_order,
    lines_in_order,
    ordered_text_batches,
    write_in_order,
)
from tidemark.sinks.text import labelled, record_text, write_text
from tidemark.sinks.upsert import UpsertTarget, checked_rows, flushes, upsert, upsert_batches

ROWS = "endtime1 long, rk int, url2 string, counts2 long"


@pytest.fixture
def target(tmp_path):
    path = str(tmp_path / "out.db")
    with sqlite3.connect(path) as db:
        db.execute(
            "CREATE TABLE url_ranks ({}, PRIMARY KEY ({}))".format(
                ", ".join(f"{f.name} {f.dataType.simpleString()} NOT NULL" for f in UPSERT_ROW),
                ", ".join(UPSERT_ROW.names[:2]),
            )
        )

    def connect():
        import sqlite3

        return sqlite3.connect(path, timeout=60)

    def table():
        with sqlite3.connect(path) as db:
            return db.execute("SELECT * FROM url_ranks ORDER BY 1, 2").fetchall()

    return UpsertTarget("url_ranks", connect, max_rows=3, writers=2), table


def test_upsert_by_key_and_again(spark, target):
    to, table = target
    first = [(10, 1, "/a", 5), (10, 2, "/b", 4), (20, 1, "/a", 1), (20, 2, "/c", 1),
             (30, 1, "/d", 7)]
    upsert(spark.createDataFrame(first, ROWS), to)
    assert table() == first
    handle = upsert_batches(to)
    change = spark.createDataFrame([(10, 1, "/b", 6), (10, 2, "/a", 5)], ROWS)
    for _ in range(2):  # a batch delivered twice
        handle(change, 1)
        assert table() == [(10, 1, "/b", 6), (10, 2, "/a", 5), *first[2:]]


def test_ranks_past_a_shorter_revision_go(spark, target):
    to, table = target
    ranks = [(w, r, f"/{r}", 9 - r) for w in (10, 20, 30) for r in range(1, 6)]
    upsert(spark.createDataFrame(ranks, ROWS), to)
    shorter = [(w, r, "/x", 1) for w in (10, 20) for r in (1, 2)]
    upsert(spark.createDataFrame(shorter, ROWS), to)
    assert table() == shorter + [row for row in ranks if row[0] == 30]


WINDOWS = [(w, r, f"/{w}/{r}", 9 - r) for w in range(1, 41) for r in range(1, 4)]


def breaking(connect, folder, failing):
    """Connections that break in mid-chunk, at the ``failing`` statements over all tasks."""

    def next_statement():
        number = 0
        while True:  # a file per statement: counted across processes
            try:
                open(os.path.join(folder, str(number)), "x").close()
                break
            except FileExistsError:
                number += 1
        if number in failing:
            raise OSError(f"the connection broke at statement {number}")

    class Cursor:
        def __init__(self, cursor):
            self.execute, self.fetchone = cursor.execute, cursor.fetchone
            self._many = cursor.executemany

        def executemany(self, statement, rows):
            rows = list(rows)
            self._many(statement, rows[: len(rows) // 2])
            next_statement()
            self._many(statement, rows[len(rows) // 2 :])

    class Connection:
        def __init__(self):
            own = connect()
            self.cursor = lambda: Cursor(own.cursor())
            self.commit, self.rollback, self.close = own.commit, own.rollback, own.close

    return Connection


@pytest.mark.parametrize("attempts", [3, 1])
def test_connections_that_break_leave_the_same_table(spark, target, tmp_path, attempts):
    """With retries the task goes on; without, the batch fails and is delivered again."""
    to, table = target
    counted = tmp_path / "statements"
    counted.mkdir()
    connect, failing, folder = to.connect, {1, 4, 5, 11}, str(counted)
    broken = dataclasses.replace(
        to, connect=breaking(connect, folder, failing), attempts=attempts,
        wait_seconds=0.01, ledger="ledger", writers=2,
    )
    with connect() as db:
        db.execute(broken.ledger_ddl())
    handle = upsert_batches(broken)
    rows = spark.createDataFrame(WINDOWS, ROWS)
    handle_failed = 0
    for _ in range(6):
        try:
            handle(rows, 7)
            break
        except Exception:
            handle_failed += 1
            # Whole windows only, whatever has been committed so far.
            assert all(sum(r[0] == w for r in table()) in (0, 3) for w in range(1, 41))
    assert table() == WINDOWS and (handle_failed > 0) == (attempts == 1)
    with connect() as db:
        assert {r[1:] for r in db.execute("SELECT * FROM ledger")} == {(7, 1)}
    # A batch that is complete is not written again.
    before = len(os.listdir(folder))
    handle(rows, 7)
    assert len(os.listdir(folder)) == before and table() == WINDOWS


def test_an_older_batch_cannot_write_over_a_newer_one(spark, target):
    to, table = target
    to = dataclasses.replace(to, ledger="ledger", attempts=1)
    with to.connect() as db:
        db.execute(to.ledger_ddl())
    upsert(spark.createDataFrame(WINDOWS, ROWS), to, 5)
    older = spark.createDataFrame([(w, 1, "/old", 0) for w in range(1, 41)], ROWS)
    with pytest.raises(Exception, match="comes after a newer one"):
        upsert(older, to, 4)
    assert table() == WINDOWS
    upsert(older, to, 6)
    assert table() == [(w, 1, "/old", 0) for w in range(1, 41)]


def test_flushes_by_rows_and_by_time():
    clock = iter(range(1000))
    rows = [Row(endtime1=w, rk=r) for w in range(6) for r in range(3)]
    by_rows = [len(f) for f in flushes(rows, 4, 1e9, lambda: 0.0)]
    assert by_rows == [6, 6, 6]  # four rows are reached within the second window
    assert [len(f) for f in flushes(rows, 100, 1e9, lambda: 0.0)] == [18]
    assert [len(f) for f in flushes(rows, 100, 2.0, lambda: 0.0)] == [18]
    # The clock goes on by one at each look: every second window boundary is two later.
    by_time = [len(f) for f in flushes(rows, 100, 2.0, lambda: next(clock))]
    assert by_time == [6, 6, 6]
    assert list(flushes([], 4, 1.0)) == []


@pytest.mark.parametrize(
    "row", [(10, 1, None, 1), (None, 1, "/a", 1), (10, None, "/a", 1), (10, 1, "/a", None),
            (10, 1, "x" * 257, 1)]
)
def test_constraints(spark, row):
    with pytest.raises(Exception, match="column constraints"):
        checked_rows(spark.createDataFrame([row], ROWS)).collect()
    assert checked_rows(spark.createDataFrame([(10, 1, "x" * 256, 1)], ROWS)).count() == 1


def test_statements():
    to = UpsertTarget("t", None, dialect="on_duplicate_key", mark="%s")
    assert to.statement() == (
        "INSERT INTO t (endtime1, rk, url2, counts2) VALUES (%s, %s, %s, %s)"
        " ON DUPLICATE KEY UPDATE url2 = VALUES(url2), counts2 = VALUES(counts2)"
    )
    assert to.trim_statement() == "DELETE FROM t WHERE endtime1 = %s AND rk > %s"


def test_reports(spark):
    ranked = spark.createDataFrame(
        [(1_511_658_000_000, 2, 3611281, 4), (1_511_658_000_000, 1, 812879, 5)],
        "window_end long, rk int, item_id long, count long",
    )
    assert reports.item_report(ranked).first().report == (
        "===============\n2017-11-26 01:00:00\n"
        "No 1:  商品ID:812879  浏览量:5\nNo 2:  商品ID:3611281  浏览量:4\n"
        "===============\n\n"
    )
    urls = ranked.select("window_end", "rk", F.lit("/p").alias("url"), "count").where("rk = 1")
    assert reports.url_report(urls).first().report == (
        "================\n2017-11-26 01:00:00\nNo 1:  UTL:/p  浏览量:5\n===============\n\n"
    )
    total = ranked.limit(1).select("window_end", F.lit(41890).cast("long").alias("count"))
    assert reports.pv_report(total).first().report == (
        "==================\n2017-11-26 01:00:00:\nPV次数:41890"
    )


def test_labelled_text(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1)], "ip string, url string, n int")
    record = record_text(df, "Record", {"ip": "ip", "theUrl": "url", "n": "n"})
    write_text(labelled(record, "sideOutPut"), str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == [
        "sideOutPut> Record(ip=a, theUrl=null, n=1)"
    ]


def test_table_form_stream_into_the_table(spark, tmp_path, target):
    """Access-log lines to a stream, its closed windows to upserts."""
    from tidemark.functions.parsing import parse_access_log
    from tidemark.plans import hot_urls
    from tidemark.sources.lines import read_lines
    from tidemark.streaming.end_of_input import END_ACCESS_LOG_LINE

    folder = tmp_path / "in"
    folder.mkdir()
    lines = [
        f"ip u - 01/01/2024:00:{i % 3:02}:{i:02} +0000 {'GET' if i % 4 else 'POST'} /p/{i % 7}"
        for i in range(50)
    ]
    (folder / "log.txt").write_text("\n".join([*lines, END_ACCESS_LOG_LINE]) + "\n")
    to, table = target
    hot_urls.start_hot_urls(
        parse_access_log(read_lines(spark, str(folder), streaming=True)),
        upsert_batches(to, hot_urls.upsert_batch()),
        str(tmp_path / "cp"),
        delay=hot_urls.DELAY,
    ).awaitTermination()
    log = parse_access_log(read_lines(spark, str(folder)))
    want = sorted(tuple(r) for r in hot_urls.upsert_rows(log).collect())
    assert table() == want and len(want) > 500


def test_text_of_a_stream_is_whole(spark, tmp_path):
    from tidemark.sinks.text import text_batches
    from tidemark.sources.lines import read_lines
    from tidemark.streaming.run import start

    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f"line {i}" for i in range(500)]
    for i in range(2):
        (folder / f"{i}.txt").write_text("\n".join(lines[i::2]) + "\n")
    stream = read_lines(spark, str(folder), streaming=True, maxFilesPerTrigger=1)
    handle = text_batches(str(tmp_path / "out"))
    start(stream, handle, str(tmp_path / "cp")).awaitTermination()
    handle(spark.read.text(str(folder / "1.txt")), 1)  # a batch delivered twice
    got = spark.read.text(str(tmp_path / "out") + "/*").collect()
    assert len(got) == 500


def _joined(spark, path):
    text = ""
    for name in files_in_order(spark, path):
        with open(name.removeprefix("file:"), encoding="utf-8") as part:
            text += part.read()
    return text


def test_files_joined_in_order_are_the_sorted_text(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(w, f"window {w}\nsecond line\n") for w in range(500)]
    df = spark.createDataFrame(rows, "window_end long, value string").repartition(7)
    write_in_order(df.where("window_end < 300"), path, ["window_end"], 9)
    handle = ordered_text_batches(path, ["window_end"])
    handle(df.where("window_end >= 400"), 11)
    handle(df.where("window_end between 300 and 350"), 10)
    handle(df.where("window_end between 300 and 399"), 10)  # run again
    want = "".join(v + "\n" for _, v in rows)
    assert _joined(spark, path) == want
    assert len(files_in_order(spark, path)) > 6  # no task wrote it all
    lines = sorted((r.line_number, r.line) for r in lines_in_order(spark, path).collect())
    assert lines == list(enumerate(want.splitlines(), 1))


def test_a_batch_without_manifest_is_not_read(spark, tmp_path):
    path = str(tmp_path / "out")
    assert files_in_order(spark, path) == [] and lines_in_order(spark, path).count() == 0
    df = spark.createDataFrame([(1, "a")], "window_end long, value string")
    write_in_order(df, path, ["window_end"], 0)
    write_text(df, f"{path}/batch_id=1")  # its task died before the manifest
    assert _joined(spark, path) == "a\n"
    write_in_order(df.where("window_end > 1"), path, ["window_end"], 2)  # an empty batch
    assert _joined(spark, path) == "a\n"


def test_reports_of_a_stream_are_printed_in_window_order(spark, tmp_path):
    from tidemark.functions.parsing import parse_behavior
    from tidemark.plans import hot_items
    from tidemark.sources.lines import read_lines
    from tidemark.streaming.end_of_input import END_BEHAVIOR_LINE

    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        lines = [f"1,{k % 4},1,pv,{1_704_067_200 + i * 4000 + k * 100}" for k in range(40)]
        (folder / f"{i}.txt").write_text("\n".join(lines) + "\n")
        os.utime(folder / f"{i}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    (folder / "3.txt").write_text(END_BEHAVIOR_LINE + "\n")
    path = str(tmp_path / "out")
    printed = ordered_text_batches(
        path, ["window_end"],
        lambda batch: hot_items.report_batch()(batch).withColumn("value", F.col("report")),
    )
    hot_items.start_hot_items(
        parse_behavior(read_lines(spark, str(folder), streaming=True, maxFilesPerTrigger=1)),
        printed, str(tmp_path / "cp"),
    ).awaitTermination()
    whole = hot_items.hot_items_report(spark, str(folder)).orderBy("window_end").collect()
    assert _joined(spark, path) == "".join(r.report + "\n" for r in whole) and len(whole) > 20
    assert len({f.split("/")[-2] for f in files_in_order(spark, path)}) > 2
