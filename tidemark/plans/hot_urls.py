"""Hot URLs: every five seconds the top N URLs by GET requests of the last ten minutes.

Two forms: with allowed lateness and a late output, and as a table with ranks
as keys for an upsert sink (there without lateness).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.clock import minutes, seconds
from ..functions.event_time import access_log_time, get_requests, rowtime
from ..functions.parsing import parse_access_log
from ..functions.reports import url_report
from ..operators.changelog import latest, ranking_changes
from ..operators.lateness import (
    Gates,
    LatenessRule,
    build_gates,
    class_steps,
    late_output,
    revised_counts,
    revised_windows,
)
from ..operators.topn import (
    as_table_rows,
    max_per_rank,
    sliding_top_n,
    top_n,
    top_n_in_blocks,
)
from ..operators.user_aggregate import TopCounts, aggregate_by
from ..operators.windows import in_blocks, sliding_count
from ..sinks.text import labelled, record_text
from ..sources.lines import read_lines
from ..streaming.batch_log import BatchLog
from ..streaming.counts import stream_count
from ..streaming.revised_top_n import RevisedTopN
from ..streaming.run import BatchHandler, into_log, start
from ..workspace import write_table

SIZE, SLIDE, TOP = minutes(10), seconds(5), 5
DELAY, LATENESS = seconds(1), seconds(60)
# Name and fields of a printed access-log record, and their columns.
RECORD = "ApacheLog"
RECORD_FIELDS = {
    "ip": "ip",
    "userId": "user_id",
    "eventTime": "event_time",
    "method": "method",
    "url": "url",
}
RANKED = StructType(
    [
        StructField("window_end", LongType()),
        StructField("rk", IntegerType()),
        StructField("url", StringType()),
        StructField("count", LongType()),
    ]
)


def url_counts(log: DataFrame, size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    return sliding_count(get_requests(access_log_time(log, DELAY)), ["url"], size, slide)


def hot_urls(log: DataFrame, n: int = TOP, size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    """Ranked rows (window_end, rk, url, count), every record counted."""
    return sliding_top_n(get_requests(access_log_time(log, DELAY)), n, "url", size, slide)


def hot_urls_report(spark, path: str, n: int = TOP) -> DataFrame:
    """From access-log lines at ``path`` to one report block per window."""
    return url_report(hot_urls(parse_access_log(read_lines(spark, path)), n))


# -- with allowed lateness, replayed on batch data ---------------------------


def replay(log: DataFrame, rule: LatenessRule | None = None) -> Gates:
    """The watermark over all records; ``log`` has event_ms and position."""
    return build_gates(log, rule or LatenessRule(SIZE, SLIDE, DELAY, LATENESS))


def too_late(log: DataFrame, gates: Gates) -> DataFrame:
    return late_output(get_requests(log), gates)


def revisions(log: DataFrame, gates: Gates) -> DataFrame:
    return revised_counts(get_requests(log), ["url"], gates)


def ranking_history(log: DataFrame, gates: Gates, n: int = TOP) -> DataFrame:
    """Each window's ranking when it closes (version 1) and, if late rows have
    come in since, when it is final (version 2).

    Counts are kept as stretches of equal counts in one table, from which both
    rankings and the revised windows are read.
    """
    requests = get_requests(log)
    steps, _ = write_table(
        class_steps(requests, ["url"], gates, rows=requests.count()), "stretches"
    )
    blocks = in_blocks(steps, "url", gates.rule.slide)
    first = F.col("on_time")
    final = F.col("on_time") + F.col("accepted_late")
    return (
        top_n_in_blocks(blocks, n, "url", first)
        .withColumn("version", F.lit(1))
        .unionByName(
            top_n_in_blocks(blocks, n, "url", final)
            .join(revised_windows(blocks.table, gates.rule), "window_end", "left_semi")
            .withColumn("version", F.lit(2))
        )
    )


def labelled_outputs(log: DataFrame, gates: Gates, n: int = TOP) -> DataFrame:
    """The two outputs of the job as it prints them: reports of every firing, and rows
    that came too late."""
    history = ranking_history(log, gates, n)
    return labelled(url_report(history, "version"), "result").unionByName(
        labelled(record_text(too_late(log, gates), RECORD, RECORD_FIELDS), "sideOutPut")
    )


def ranking_retracts(history: DataFrame) -> DataFrame:
    """The ranking as change rows: what each firing takes back and adds."""
    return ranking_changes(history, ["url", "count"])


def folded_ranking(changes: DataFrame) -> DataFrame:
    """Change rows folded back into the table they describe."""
    return latest(changes, ["window_end", "rk"], "seq", is_add="is_add")


def current_ranking(history: DataFrame) -> DataFrame:
    return latest(history, ["window_end", "rk"], "version")


# -- table form --------------------------------------------------------------


def table_counts(log: DataFrame, size: int = SIZE, slide: int = SLIDE) -> DataFrame:
    """url, counts, endtime: counts non-null urls per url and window."""
    timed = rowtime(access_log_time(log, DELAY), "method", "url")
    counted = sliding_count(
        get_requests(timed), ["url"], size, slide, ts="rt", counted="url", name="counts"
    )
    return counted.select("url", "counts", F.col("window_end").alias("endtime"))


def table_top(counts: DataFrame, n: int = TOP) -> DataFrame:
    """endtime1, rk, url1, counts1. A windowed count has one row per url and window."""
    return as_table_rows(
        top_n(
            counts.select(
                F.col("endtime").alias("window_end"), "url", F.col("counts").alias("count")
            ),
            n,
            "url",
        ),
        "url",
    )


def table_top_by_aggregate(counts: DataFrame, n: int = TOP) -> DataFrame:
    """As :func:`table_top`, by an aggregate of the user surface."""
    ranked = aggregate_by(counts, ["endtime"], TopCounts(n, "url", "counts"))
    return ranked.select(
        F.col("endtime").alias("endtime1"),
        "rk",
        F.col("url").alias("url1"),
        F.col("counts").alias("counts1"),
    )


def upsert_rows(log: DataFrame, n: int = TOP) -> DataFrame:
    """endtime1, rk, url2, counts2: what the upsert table ends up with.

    Its columns take no nulls, so records without url are left out.
    """
    return max_per_rank(as_table_rows(hot_urls(log.where("url is not null"), n), "url"))


# -- streams -----------------------------------------------------------------


def start_hot_urls(
    log: DataFrame,
    handle: BatchLog | BatchHandler,
    checkpoint: str,
    *,
    n: int = TOP,
    delay: int = DELAY + LATENESS,
    interval: str | None = None,
    timed: bool = False,
) -> StreamingQuery:
    """Each window once, final. The default delay waits out the allowed lateness."""
    records = log if timed else access_log_time(log, delay)
    counts = stream_count(get_requests(records), ["url"], SIZE, SLIDE)
    if isinstance(handle, BatchLog):
        handle = into_log(handle, lambda batch: top_n(batch, n, "url"))
    return start(counts, handle, checkpoint, interval=interval)


def start_hot_urls_late(
    log: DataFrame,
    job: RevisedTopN,
    checkpoint: str,
    *,
    interval: str | None = None,
    timed: bool = False,
) -> StreamingQuery:
    """First and revised rankings, and the late output, as the data come in.

    ``timed``: ``log`` carries ``ts`` and a watermark that is ``job.delay`` behind.
    """
    records = log if timed else access_log_time(log, job.delay)
    return start(job.stream(get_requests(records)), job, checkpoint, interval=interval)


def late_job(spark, path: str, records: StructType, n: int = TOP, **rule) -> RevisedTopN:
    """Job for :func:`start_hot_urls_late`; ``records`` is the schema of its late output."""
    rule = {"size": SIZE, "slide": SLIDE, "delay": DELAY, "lateness": LATENESS, **rule}
    return RevisedTopN(spark, path, records, key="url", n=n, rule=LatenessRule(**rule))


def upsert_batch(n: int = TOP):
    """Closed windows' counts to upsert rows, for a sink handler."""

    def transform(batch: DataFrame) -> DataFrame:
        return max_per_rank(as_table_rows(top_n(batch, n, "url"), "url"))

    return transform
