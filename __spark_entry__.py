
from __future__ import annotations

import functools
import os
import sys
import warnings
from collections.abc import Callable

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions import event_time, parsing, reports, salts  # noqa: E402
from tidemark.operators import changelog, lateness, topn  # noqa: E402
from tidemark.operators.upkeep import WindowTable  # noqa: E402
from tidemark.plans import hot_items, hot_urls, page_views  # noqa: E402
from tidemark.schemas import REPORTS, UPSERT_ROW  # noqa: E402
from tidemark.sinks.ordered_text import lines_in_order, write_in_order  # noqa: E402
from tidemark.sinks.text import labelled, record_text  # noqa: E402
from tidemark.sinks.upsert import checked_rows  # noqa: E402
from tidemark.sources import events as ev  # noqa: E402
from tidemark.streaming.batch_log import BatchLog  # noqa: E402
from tidemark.streaming.end_of_input import BoundedInput  # noqa: E402
from tidemark.streaming.open_state import open_windows, watermark_ms  # noqa: E402
from tidemark.streaming.run import into_log  # noqa: E402
from tidemark.workspace import date_files, new_folder, write_table  # noqa: E402

try:  # the training-data operators and libraries they need may be absent
    import corpus_pipeline
    from tidemark.llm import queries as llm_queries
except ImportError as missing:
    warnings.warn(f"the training-data queries are left out: {missing}", stacklevel=2)
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# -- inputs -------------------------------------------------------------------


def _behavior(spark, sf_dir, *extra):
    return ev.as_behavior(ev.read_events(spark, sf_dir), *extra)


def _log(spark, sf_dir, *extra):
    return ev.as_access_log(ev.read_events(spark, sf_dir), *extra)


def _views(spark, sf_dir, *extra):
    """Behavior records of page views, read by a pushed-down filter."""
    return ev.as_behavior(ev.of_types(ev.read_events(spark, sf_dir), ev.VIEW_TYPES), *extra)


def _requests(spark, sf_dir, *extra):
    """Access-log records of GET requests, read by a pushed-down filter."""
    return ev.as_access_log(ev.of_types(ev.read_events(spark, sf_dir), ev.GET_TYPES), *extra)


def _arrival(step):
    """When an event arrives, in milliseconds: up to 999 steps of ``step`` late."""
    return F.unix_millis("ts") + F.pmod(F.col("event_id") * 7919, F.lit(1000)) * step


def _arriving_log(spark, sf_dir):
    """The access log with millisecond event time and a disordered arrival."""
    return _log(
        spark,
        sf_dir,
        "event_id",
        F.unix_millis("ts").alias("event_ms"),
        lateness.arrival_position(_arrival(1200), F.col("event_id")).alias("position"),
    )


def _numbered_salt(prefix):
    return salts.numbered_salt(prefix, F.col("event_id"))


# -- sources, projections, filters --------------------------------------------


def behavior_parse(spark, sf_dir):
    lines = ev.behavior_lines(_behavior(spark, sf_dir))
    timed = event_time.behavior_time(parsing.parse_behavior(lines))
    return timed.withColumn("event_ms", F.unix_millis("ts")).drop("ts")


def access_log_parse(spark, sf_dir):
    return parsing.parse_access_log(ev.access_log_lines(_log(spark, sf_dir)))


def behavior_quarantine(spark, sf_dir):
    """Every record of another kind than a page view is cut short, hence malformed."""
    lines = ev.behavior_lines(_behavior(spark, sf_dir)).select(
        F.when(F.col("value").contains(",pv,"), F.col("value"))
        .otherwise(F.substring_index("value", ",", 3))
        .alias("value")
    )
    good, bad = parsing.split_behavior(lines)
    return good.select(F.lit("good").alias("label"), F.concat_ws(
        ",", *[F.col(c).cast("string") for c in good.columns]).alias("value")
    ).unionByName(bad.select(F.lit("bad").alias("label"), "value"))


def access_log_quarantine(spark, sf_dir):
    """Every record that is no GET request is cut short, hence malformed."""
    lines = ev.access_log_lines(_log(spark, sf_dir)).select(
        F.when(F.col("value").contains(" GET "), F.col("value"))
        .otherwise(F.substring_index("value", " ", 5))
        .alias("value")
    )
    good, bad = parsing.split_access_log(lines)
    return good.select(F.lit("good").alias("label"), F.concat_ws(
        " ", *[F.col(c).cast("string") for c in good.columns]).alias("value")
    ).unionByName(bad.select(F.lit("bad").alias("label"), "value"))


def behavior_filter_pv(spark, sf_dir):
    return event_time.page_views(_behavior(spark, sf_dir))


def access_log_filter_get(spark, sf_dir):
    return event_time.get_requests(_log(spark, sf_dir))


def rowtime_projection(spark, sf_dir):
    timed = event_time.access_log_time(_log(spark, sf_dir))
    rows = event_time.rowtime(timed, "method", "url")
    return rows.select("method", "url", F.unix_millis("rt").alias("rt"))


# -- windowed counts and totals -----------------------------------------------


def sliding_count_items(spark, sf_dir):
    return hot_items.item_counts(_views(spark, sf_dir))


def sliding_count_urls(spark, sf_dir):
    return hot_urls.url_counts(_requests(spark, sf_dir))


def table_sliding_count(spark, sf_dir):
    return hot_urls.table_counts(_requests(spark, sf_dir))


def window_upkeep(spark, sf_dir):
    """Item counts kept up load by load, in order of arrival, some rows days late."""
    table = WindowTable(
        spark, new_folder(spark, "kept-up"), "item_id long", hot_items.SIZE, hot_items.SLIDE
    )
    arrival = _arrival(UPKEEP_STEP)
    views = event_time.page_views(
        event_time.behavior_time(_views(spark, sf_dir, arrival.alias("arrival")))
    )
    low, high = ev.read_events(spark, sf_dir).agg(F.min(arrival), F.max(arrival)).first()
    for number in range(UPKEEP_LOADS if low is not None else 0):
        part = F.expr(f"(arrival - {low}L) * {UPKEEP_LOADS}L div {high - low + 1}L")
        table.add(views.where(part == number), f"load-{number}")
    return table.windows()


def pv_plain_total(spark, sf_dir):
    return page_views.page_view_total_plain(_views(spark, sf_dir))


def salted_partial_count(spark, sf_dir):
    return page_views.page_view_partials(
        _views(spark, sf_dir, "event_id"), _numbered_salt("pv_")
    )


def salt_udf(spark, sf_dir):
    views = event_time.page_views(_views(spark, sf_dir, "event_id"))
    return views.select("event_id", _numbered_salt(F.col("behavior")).alias("random_k"))


def pv_salted_total(spark, sf_dir):
    return page_views.page_view_total(
        _views(spark, sf_dir), salt=salts.random_salt("pv_", seed=7)
    )


def pv_user_aggregate(spark, sf_dir):
    return page_views.page_view_total_by_aggregate(_views(spark, sf_dir))


def hot_salted_counts(spark, sf_dir):
    """Page views per item and hour; only items with a share of all rows are salted."""
    return hot_items.hourly_item_counts(_views(spark, sf_dir))


def pv_table_total(spark, sf_dir):
    return page_views.table_totals(page_views.table_partials(_views(spark, sf_dir)))


# -- rankings -----------------------------------------------------------------


def hot_items_topn(spark, sf_dir):
    return hot_items.hot_items(_views(spark, sf_dir))


def hot_urls_topn(spark, sf_dir):
    return hot_urls.hot_urls(_requests(spark, sf_dir))


def topn_table_agg(spark, sf_dir):
    return hot_urls.table_top(hot_urls.table_counts(_requests(spark, sf_dir)))


def topn_user_aggregate(spark, sf_dir):
    return hot_urls.table_top_by_aggregate(hot_urls.table_counts(_requests(spark, sf_dir)))


def topn_max_of_history(spark, sf_dir):
    """Top five by the largest of several counts reported per url and window."""
    log = _arriving_log(spark, sf_dir)
    counts = hot_urls.revisions(log, hot_urls.replay(log))
    history = counts.select(
        "window_end",
        "url",
        F.explode(F.array("first_count", "final_count")).alias("count"),
    )
    return topn.as_table_rows(topn.top_n_of_max(history, hot_urls.TOP, "url"), "url")


def topn_rank_max(spark, sf_dir):
    return hot_urls.upsert_rows(_requests(spark, sf_dir))


def topn_upsert_table(spark, sf_dir):
    return checked_rows(hot_urls.upsert_rows(_requests(spark, sf_dir)))


# -- lateness and change rows -------------------------------------------------


def lateness_class(spark, sf_dir):
    log = _arriving_log(spark, sf_dir)
    return lateness.class_counts(log, [], hot_urls.replay(log))


def late_revision(spark, sf_dir):
    log = _arriving_log(spark, sf_dir)
    return hot_urls.revisions(log, hot_urls.replay(log))


def late_side_output(spark, sf_dir):
    log = _arriving_log(spark, sf_dir)
    late = hot_urls.too_late(log, hot_urls.replay(log))
    return late.select("event_id", "url", "event_ms")


def late_side_output_text(spark, sf_dir):
    """The late output as labelled text."""
    log = _arriving_log(spark, sf_dir)
    late = hot_urls.too_late(log, hot_urls.replay(log))
    return labelled(record_text(late, hot_urls.RECORD, hot_urls.RECORD_FIELDS), "sideOutPut")


def hot_urls_labelled(spark, sf_dir):
    """Both labelled outputs of the job: reports of every firing, and late records."""
    log = _arriving_log(spark, sf_dir)
    return hot_urls.labelled_outputs(log, hot_urls.replay(log))


def hot_urls_revised(spark, sf_dir):
    log = _arriving_log(spark, sf_dir)
    return hot_urls.ranking_history(log, hot_urls.replay(log))


def changelog_materialize(spark, sf_dir):
    return hot_urls.current_ranking(hot_urls_revised(spark, sf_dir))


def topn_retract_changelog(spark, sf_dir):
    """The ranking's change rows, from its first firing to its last."""
    return hot_urls.ranking_retracts(hot_urls_revised(spark, sf_dir))


def topn_retract_materialize(spark, sf_dir):
    """The ranking's change rows folded back into the table of rankings."""
    return hot_urls.folded_ranking(topn_retract_changelog(spark, sf_dir))


def pv_retract_changelog(spark, sf_dir):
    partials = page_views.table_partials(
        _views(spark, sf_dir, "event_id"), salt=_numbered_salt(F.col("behavior"))
    )
    return page_views.table_changes(partials)


def pv_retract_materialize(spark, sf_dir):
    """The change rows folded back into the table of totals."""
    changes = pv_retract_changelog(spark, sf_dir)
    return changelog.latest(changes, ["endtime"], "seq", is_add="is_add").select(
        "counts", "endtime"
    )


# -- reports ------------------------------------------------------------------


def hot_items_report(spark, sf_dir):
    return reports.item_report(hot_items_topn(spark, sf_dir))


def hot_urls_report(spark, sf_dir):
    return reports.url_report(hot_urls_topn(spark, sf_dir))


def pv_report(spark, sf_dir):
    return reports.pv_report(pv_salted_total(spark, sf_dir))


def _printed(reported, spark):
    """Reports printed in the order of their windows, read back line by line."""
    path = new_folder(spark, "printed")
    write_in_order(reported.withColumn("value", F.col("report")), path, ["window_end"])
    return lines_in_order(spark, path)


def hot_items_report_text(spark, sf_dir):
    return _printed(hot_items_report(spark, sf_dir), spark)


def pv_report_text(spark, sf_dir):
    return _printed(pv_report(spark, sf_dir), spark)


# -- streams: run over all of events, then read back ---------------------------


#: Each stream query takes its input in several micro-batches: files, at least so
#: many, of at most so many rows.
STREAM_FILES, STREAM_FILE_ROWS = 4, 5_000_000
#: Bytes of a row group in these files, and rows after which its size is looked at.
STREAM_ROW_GROUPS = {
    "parquet.block.size": 2 << 20,
    "parquet.page.size.row.check.max": 1_000,
}
#: The same where events arrive in disorder, up to some hours late.
ARRIVAL_FILES, ARRIVAL_STEP = 8, 12_000
#: Loads of the kept-up table; rows arrive up to four days late there.
UPKEEP_LOADS, UPKEEP_STEP = 4, 360_000


def _as_stream(spark, parts):
    """A stream of one partition of ``parts``, that is one file, per micro-batch.

    A stream takes files by their age: all are written at once, then dated in order. Row
    groups are small, so that all tasks read of the one file.
    """
    folder = new_folder(spark, "arrived")
    parts.write.options(**STREAM_ROW_GROUPS).parquet(f"{folder}/events.parquet")
    date_files(spark, f"{folder}/events.parquet")
    return ev.read_events(spark, folder, streaming=True, maxFilesPerTrigger=1)


def _in_files(spark, sf_dir):
    """``events`` as a stream in several micro-batches, in order of time."""
    events = ev.read_events(spark, sf_dir).withColumn("ts", F.to_timestamp_ntz("ts"))
    n = max(STREAM_FILES, -(-events.count() // STREAM_FILE_ROWS))
    return _as_stream(spark, events.repartitionByRange(n, "ts"))


def _as_they_arrive(spark, sf_dir):
    """``events`` as a stream in order of arrival, a micro-batch per stretch of time."""
    events = ev.read_events(spark, sf_dir).withColumn("arrival", _arrival(ARRIVAL_STEP))
    low, high, rows = events.agg(F.min("arrival"), F.max("arrival"), F.count("*")).first()
    n = max(ARRIVAL_FILES, -(-rows // STREAM_FILE_ROWS))
    part = F.lit(0)
    if rows:
        part = F.expr(f"(arrival - {low}L) * {n}L div {high - low + 1}L").cast("int")
    return _as_stream(
        spark,
        events.withColumn("part", part)
        .repartitionById(n, "part")
        .drop("arrival", "part")
        .withColumn("ts", F.to_timestamp_ntz("ts")),
    )


def _bounded(spark, sf_dir, kind, convert):
    """``events`` as a stream of records with ``ts``, and a closing row."""
    records = convert(_in_files(spark, sf_dir), "ts")
    return BoundedInput(records, new_folder(spark, "end-of-input"), kind, "ts")


def _behavior_stream(spark, sf_dir):
    bounded = _bounded(spark, sf_dir, "behavior", ev.as_behavior)
    return bounded, event_time.with_event_time(bounded.rows, F.col("ts"), 0)


def _log_stream(spark, sf_dir, delay):
    bounded = _bounded(spark, sf_dir, "method", ev.as_access_log)
    return bounded, event_time.with_event_time(bounded.rows, F.col("ts"), delay)


def _run(spark, bounded, schema, begin):
    """Run a stream into a new log to the end of its input, return the log."""
    folder = new_folder(spark, "stream")
    log = BatchLog(spark, f"{folder}/out", schema)
    bounded.run(lambda: begin(log, f"{folder}/checkpoint"))
    return log


def hot_items_stream(spark, sf_dir):
    bounded, records = _behavior_stream(spark, sf_dir)
    return _run(
        spark,
        bounded,
        hot_items.RANKED,
        lambda log, at: hot_items.start_hot_items(records, log, at, timed=True),
    ).rows()


def hot_items_report_stream(spark, sf_dir):
    """One report block per window, as the windows close."""
    bounded, records = _behavior_stream(spark, sf_dir)
    return _run(
        spark,
        bounded,
        REPORTS,
        lambda log, at: hot_items.start_hot_items(
            records, into_log(log, hot_items.report_batch()), at, timed=True
        ),
    ).rows()


def hot_urls_stream(spark, sf_dir):
    bounded, records = _log_stream(spark, sf_dir, hot_urls.DELAY + hot_urls.LATENESS)
    return _run(
        spark,
        bounded,
        hot_urls.RANKED,
        lambda log, at: hot_urls.start_hot_urls(records, log, at, timed=True),
    ).rows()


def hot_urls_table_stream(spark, sf_dir):
    """The table form: upsert rows per micro-batch, the last one per key wins."""
    bounded, records = _log_stream(spark, sf_dir, hot_urls.DELAY)
    log = _run(
        spark,
        bounded,
        UPSERT_ROW,
        lambda log, at: hot_urls.start_hot_urls(
            records, into_log(log, hot_urls.upsert_batch()), at, timed=True
        ),
    )
    return changelog.latest(log.read(), ["endtime1", "rk"], "batch_id")


def _late_job(spark, rows):
    """The job with allowed lateness, run over ``rows`` to their end."""
    bounded = BoundedInput(rows, new_folder(spark, "end-of-input"), "method", "ts")
    folder = new_folder(spark, "stream")
    job = hot_urls.late_job(spark, folder, rows.schema)
    records = event_time.with_event_time(bounded.rows, F.col("ts"), job.delay)
    bounded.run(
        lambda: hot_urls.start_hot_urls_late(records, job, f"{folder}/checkpoint", timed=True)
    )
    return job


def hot_urls_late_stream(spark, sf_dir):
    return _late_job(spark, ev.as_access_log(_in_files(spark, sf_dir), "ts")).current()


def _late_job_as_they_arrive(spark, sf_dir):
    """The job with allowed lateness over events in disorder."""
    return _late_job(spark, ev.as_access_log(_as_they_arrive(spark, sf_dir), "event_id", "ts"))


def hot_urls_firings_stream(spark, sf_dir):
    """Each window's rankings as they fire: when it closes, and after late rows."""
    return _late_job_as_they_arrive(spark, sf_dir).firings()


def hot_urls_late_output_stream(spark, sf_dir):
    """Rows that come too late for all their windows."""
    late = _late_job_as_they_arrive(spark, sf_dir).late.rows()
    return late.select("event_id", "url", F.unix_millis("ts").alias("event_ms"))


def open_windows_stream(spark, sf_dir):
    """What a stopped job still holds: windows open to late rows, and their counts."""
    rows = ev.as_access_log(_in_files(spark, sf_dir), "ts")
    folder = new_folder(spark, "stream")
    job = hot_urls.late_job(spark, folder, rows.schema)
    records = event_time.with_event_time(rows, F.col("ts"), job.delay)
    query = hot_urls.start_hot_urls_late(records, job, f"{folder}/checkpoint", timed=True)
    query.awaitTermination()
    return open_windows(
        spark, f"{folder}/checkpoint", "url string", job.rule.size, job.rule.slide, watermark_ms(query)
    )


def pv_stream(spark, sf_dir):
    bounded, records = _behavior_stream(spark, sf_dir)
    return _run(
        spark,
        bounded,
        page_views.TOTALS,
        lambda log, at: page_views.start_page_views(records, log, at, timed=True),
    ).rows()


def pv_report_stream(spark, sf_dir):
    bounded, records = _behavior_stream(spark, sf_dir)
    return _run(
        spark,
        bounded,
        REPORTS,
        lambda log, at: page_views.start_page_views(
            records, into_log(log, reports.pv_report), at, timed=True
        ),
    ).rows()


def pv_changes_stream(spark, sf_dir):
    """Change rows of the salted total, folded back into the table of totals."""
    bounded, records = _behavior_stream(spark, sf_dir)
    log = _run(
        spark,
        bounded,
        page_views.CHANGES,
        lambda log, at: page_views.start_page_view_changes(records, log, at, timed=True),
    )
    return changelog.latest(log.rows(), ["endtime"], "seq", is_add="is_add").select(
        "counts", "endtime"
    )


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top five items per sliding hour."""
    return hot_items_topn(spark, SMOKE_DIR)


_QUERIES = [
    behavior_parse,
    access_log_parse,
    behavior_quarantine,
    access_log_quarantine,
    behavior_filter_pv,
    access_log_filter_get,
    rowtime_projection,
    sliding_count_items,
    sliding_count_urls,
    table_sliding_count,
    window_upkeep,
    pv_plain_total,
    salted_partial_count,
    salt_udf,
    pv_salted_total,
    pv_table_total,
    pv_user_aggregate,
    hot_salted_counts,
    hot_items_topn,
    hot_urls_topn,
    topn_table_agg,
    topn_user_aggregate,
    topn_max_of_history,
    topn_rank_max,
    topn_upsert_table,
    lateness_class,
    late_revision,
    late_side_output,
    late_side_output_text,
    hot_urls_labelled,
    hot_urls_revised,
    changelog_materialize,
    topn_retract_changelog,
    topn_retract_materialize,
    pv_retract_changelog,
    pv_retract_materialize,
    hot_items_report,
    hot_urls_report,
    pv_report,
    hot_items_report_text,
    pv_report_text,
    hot_items_stream,
    hot_items_report_stream,
    pv_report_stream,
    hot_urls_stream,
    hot_urls_table_stream,
    hot_urls_late_stream,
    hot_urls_firings_stream,
    hot_urls_late_output_stream,
    open_windows_stream,
    pv_stream,
    pv_changes_stream,
]


def _with_workers_path(query):
    """``query``, with this folder on the path of Spark's Python workers."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if HERE not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([HERE, *paths])
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in _QUERIES}
    if llm_queries is not None:
        found |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _with_workers_path(query) for name, query in found.items()}


# -- SQL equivalents ----------------------------------------------------------

_BASE = """
WITH e AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         epoch_us(ts) // 1000 AS ms, epoch_us(ts) // 1000000 AS s
  FROM events),
b AS (
  SELECT event_id, user_id, item_id, CAST(item_id % 10 AS INTEGER) AS category_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
         s AS "timestamp", ms
  FROM e),
l AS (
  SELECT event_id, '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id,
         s * 1000 AS event_time,
         CASE WHEN event_type IN ('view', 'click') THEN 'GET'
              WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'HEAD' END AS method,
         '/p/' || item_id AS url, ms
  FROM e)
"""

_ITEM_COUNTS = """, ic AS (
  SELECT (ms // 300000) * 300000 + 300000 * g.i AS window_end, item_id, count(*) AS "count"
  FROM b, range(1, 13) g(i) WHERE behavior = 'pv' GROUP BY 1, 2),
it AS (
  SELECT window_end,
         CAST(row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, item_id)
              AS INTEGER) AS rk, item_id, "count"
  FROM ic QUALIFY rk <= 5)
"""

_URL_COUNTS = """, uc AS (
  SELECT (event_time // 5000) * 5000 + 5000 * g.i AS window_end, url, count(*) AS "count"
  FROM l, range(1, 121) g(i) WHERE method = 'GET' GROUP BY 1, 2),
ut AS (
  SELECT window_end,
         CAST(row_number() OVER (PARTITION BY window_end ORDER BY "count" DESC, url)
              AS INTEGER) AS rk, url, "count"
  FROM uc QUALIFY rk <= 5)
"""

_TOTALS = """, t AS (
  SELECT (ms // 3600000) * 3600000 + 3600000 AS window_end, count(*) AS "count"
  FROM b WHERE behavior = 'pv' GROUP BY 1)
"""

_PARTIALS = """, p AS (
  SELECT (ms // 3600000) * 3600000 + 3600000 AS window_end,
         behavior || (event_id % 8) AS random_k, count(*) AS "count"
  FROM b WHERE behavior = 'pv' GROUP BY 1, 2),
r AS (
  SELECT window_end,
         row_number() OVER (PARTITION BY window_end ORDER BY random_k) AS v,
         CAST(sum("count") OVER (PARTITION BY window_end ORDER BY random_k) AS BIGINT) AS total
  FROM p),
c AS (
  SELECT true AS is_add, total AS counts, window_end AS endtime,
         CAST(2 * v - 1 AS INTEGER) AS seq FROM r
  UNION ALL
  SELECT false, lag(total) OVER (PARTITION BY window_end ORDER BY v), window_end,
         CAST(2 * v - 2 AS INTEGER) FROM r QUALIFY v > 1)
"""

_LATE = """, a AS MATERIALIZED (
  SELECT *, max(ms) OVER (ORDER BY ms + ((event_id * 7919) % 1000) * 1200, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000 AS wm
  FROM l),
x AS MATERIALIZED (
  SELECT a.*, (ms // 5000) * 5000 + 5000 * g.i AS window_end,
         coalesce(wm < window_end - 1, true) AS is_on_time,
         coalesce(wm < window_end - 1 + 60000, true) AS is_accepted
  FROM a, range(1, 121) g(i)),
rv AS MATERIALIZED (
  SELECT window_end, url, count(*) FILTER (is_on_time) AS first_count,
         count(*) FILTER (is_accepted) AS final_count
  FROM x WHERE method = 'GET' GROUP BY 1, 2 HAVING final_count > 0),
ch AS (SELECT DISTINCT window_end FROM rv WHERE final_count > first_count),
tl AS (
  SELECT * FROM a
  WHERE method = 'GET' AND (ms // 5000) * 5000 + 600000 - 1 + 60000 <= wm),
v1 AS (
  SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end
           ORDER BY first_count DESC, url) AS INTEGER) AS rk, url, first_count AS "count"
  FROM rv WHERE first_count > 0 QUALIFY rk <= 5),
v2 AS (
  SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end
           ORDER BY final_count DESC, url) AS INTEGER) AS rk, url, final_count AS "count"
  FROM rv QUALIFY rk <= 5)
"""

# One watermark per micro-batch; ``fr`` has the micro-batches that rank a window: the
# one that closes it (the closing row comes last), and later ones with rows for it.
_BATCHES = f""", ar AS (
  SELECT *, ms + ((event_id * 7919) % 1000) * {ARRIVAL_STEP} AS arrival FROM l),
sp AS (
  SELECT min(arrival) AS low, max(arrival) AS high,
         greatest({ARRIVAL_FILES}, (count(*) + {STREAM_FILE_ROWS - 1}) // {STREAM_FILE_ROWS}) AS n
  FROM ar),
ba AS MATERIALIZED (
  SELECT ar.*, ((arrival - low) * n) // (high - low + 1) AS batch FROM ar, sp),
hi AS (SELECT batch, max(max(ms)) OVER (ORDER BY batch) AS high FROM ba GROUP BY batch),
wa AS MATERIALIZED (SELECT batch, high, lag(high) OVER (ORDER BY batch) - 1000 AS wm FROM hi),
bc AS MATERIALIZED (
  SELECT batch, url, (ms // 5000) * 5000 + 5000 * g.i AS window_end, count(*) AS n
  FROM ba JOIN wa USING (batch), range(1, 121) g(i)
  WHERE method = 'GET' AND coalesce(window_end - 1 + 60000 > wm, true) GROUP BY ALL),
cb AS (
  SELECT w.window_end, coalesce(min(wa.batch), (SELECT n FROM sp)) AS closing
  FROM (SELECT DISTINCT window_end FROM bc) w
  LEFT JOIN wa ON wa.high - 1000 >= w.window_end - 1 GROUP BY 1),
fr AS MATERIALIZED (
  SELECT window_end, closing AS fired FROM cb
  UNION
  SELECT window_end, batch FROM bc JOIN cb USING (window_end) WHERE batch > closing),
rf AS (
  SELECT window_end, fired,
         CAST(row_number() OVER (PARTITION BY window_end, fired ORDER BY "count" DESC, url)
              AS INTEGER) AS rk, url, "count"
  FROM (SELECT window_end, fired, url, CAST(sum(n) AS BIGINT) AS "count"
        FROM fr JOIN bc USING (window_end) WHERE batch <= fired GROUP BY 1, 2, 3)
  QUALIFY rk <= 5)
"""

_TIME = "strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S')"
# The printed form of a late record and of a URL report.
_LATE_TEXT = """'sideOutPut> ApacheLog(ip=' || ip || ', userId=' || user_id || ', eventTime='
             || event_time || ', method=' || method || ', url=' || url || ')'"""
_URL_REPORT = f"""'================' || chr(10) || {_TIME} || chr(10) ||
             string_agg('No ' || rk || ':  UTL:' || url || '  浏览量:' || "count"
                        || chr(10), '' ORDER BY rk)
             || '===============' || chr(10) || chr(10)"""
_ITEMS = _BASE + _ITEM_COUNTS
_URLS = _BASE + _URL_COUNTS
_LATENESS = _BASE + _LATE
_ARRIVING = _BASE + _BATCHES
_TABLE_ROWS = _URLS + (
    'SELECT window_end AS endtime1, rk, url AS url2, "count" AS counts2 FROM ut'
)
_TOP_ITEMS = _ITEMS + 'SELECT window_end, rk, item_id, "count" FROM it'
_TOP_URLS = _URLS + 'SELECT window_end, rk, url, "count" FROM ut'
_PLAIN = _BASE + _TOTALS + 'SELECT window_end, "count" FROM t'
_TABLE_TOTALS = _BASE + _TOTALS + 'SELECT "count" AS counts, window_end AS endtime FROM t'


def oracle_sql() -> dict[str, str]:
    found = _own_sql()
    if llm_queries is not None:
        found |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _own_sql() -> dict[str, str]:
    found = _batch_sql()
    found["window_upkeep"] = found["sliding_count_items"]
    found["topn_user_aggregate"] = found["topn_table_agg"]
    found["pv_user_aggregate"] = found["pv_plain_total"]
    for name in ("hot_items_report", "pv_report"):
        found[f"{name}_stream"] = found[name]
        found[f"{name}_text"] = f"""
SELECT row_number() OVER (ORDER BY window_end, i) AS line_number, line
FROM (SELECT window_end, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
      FROM (SELECT window_end, string_split(report, chr(10)) AS lines FROM ({found[name]})))"""
    return found


def _batch_sql() -> dict[str, str]:
    return {
        "behavior_parse": _BASE
        + """SELECT user_id, item_id, category_id, behavior, "timestamp",
             "timestamp" * 1000 AS event_ms FROM b""",
        "access_log_parse": _BASE + "SELECT ip, user_id, event_time, method, url FROM l",
        "behavior_quarantine": _BASE
        + """SELECT CASE WHEN behavior = 'pv' THEN 'good' ELSE 'bad' END AS label,
             concat_ws(',', user_id, item_id, category_id) ||
             CASE WHEN behavior = 'pv' THEN ',pv,' || "timestamp" ELSE '' END AS value
             FROM b""",
        "access_log_quarantine": _BASE
        + """SELECT CASE WHEN method = 'GET' THEN 'good' ELSE 'bad' END AS label,
             CASE WHEN method = 'GET'
                  THEN concat_ws(' ', ip, user_id, event_time, method, url)
                  ELSE concat_ws(' ', ip, user_id, '-', strftime(make_timestamp(event_time * 1000),
                                 '%d/%m/%Y:%H:%M:%S'), '+0000') END AS value
             FROM l""",
        "behavior_filter_pv": _BASE
        + """SELECT user_id, item_id, category_id, behavior, "timestamp"
             FROM b WHERE behavior = 'pv'""",
        "access_log_filter_get": _BASE
        + "SELECT ip, user_id, event_time, method, url FROM l WHERE method = 'GET'",
        "rowtime_projection": _BASE + "SELECT method, url, event_time AS rt FROM l",
        "sliding_count_items": _ITEMS + "SELECT * FROM ic",
        "sliding_count_urls": _URLS + "SELECT * FROM uc",
        "table_sliding_count": _URLS
        + 'SELECT url, "count" AS counts, window_end AS endtime FROM uc',
        "pv_plain_total": _PLAIN,
        "salted_partial_count": _BASE
        + """SELECT (ms // 3600000) * 3600000 + 3600000 AS window_end,
             'pv_' || (event_id % 8) AS salt_key, count(*) AS "count"
             FROM b WHERE behavior = 'pv' GROUP BY 1, 2""",
        "salt_udf": _BASE
        + """SELECT event_id, behavior || (event_id % 8) AS random_k
             FROM b WHERE behavior = 'pv'""",
        "pv_salted_total": _PLAIN,
        "pv_table_total": _TABLE_TOTALS,
        "hot_items_topn": _TOP_ITEMS,
        "hot_urls_topn": _TOP_URLS,
        "topn_table_agg": _URLS
        + 'SELECT window_end AS endtime1, rk, url AS url1, "count" AS counts1 FROM ut',
        "topn_max_of_history": _LATENESS
        + 'SELECT window_end AS endtime1, rk, url AS url1, "count" AS counts1 FROM v2',
        "topn_rank_max": _TABLE_ROWS,
        "topn_upsert_table": _TABLE_ROWS,
        "lateness_class": _LATENESS
        + """SELECT window_end, count(*) FILTER (is_on_time) AS on_time,
             count(*) FILTER (is_accepted AND NOT is_on_time) AS accepted_late,
             count(*) FILTER (NOT is_accepted) AS dropped FROM x GROUP BY 1""",
        "late_revision": _LATENESS + "SELECT * FROM rv",
        "late_side_output": _LATENESS + "SELECT event_id, url, ms AS event_ms FROM tl",
        "late_side_output_text": _LATENESS
        + f"SELECT {_LATE_TEXT} AS value FROM tl",
        "hot_urls_labelled": _LATENESS
        + f""", h AS (SELECT *, 1 AS version FROM v1 UNION ALL
             SELECT *, 2 FROM v2 WHERE window_end IN (SELECT window_end FROM ch))
             SELECT 'result> ' || {_URL_REPORT} AS value FROM h GROUP BY window_end, version
             UNION ALL SELECT {_LATE_TEXT} FROM tl""",
        "hot_urls_revised": _LATENESS
        + """SELECT *, 1 AS version FROM v1 UNION ALL
             SELECT *, 2 FROM v2 WHERE window_end IN (SELECT window_end FROM ch)""",
        "changelog_materialize": _LATENESS + "SELECT * FROM v2",
        "hot_salted_counts": _BASE
        + """SELECT (ms // 3600000) * 3600000 + 3600000 AS window_end, item_id, count(*) AS "count"
             FROM b WHERE behavior = 'pv' GROUP BY 1, 2""",
        "open_windows_stream": _BASE
        + """, op AS (
  SELECT (ms // 5000) * 5000 + 5000 * g.i AS window_end, url, count(*) AS "count"
  FROM l, range(1, 121) g(i) WHERE method = 'GET' GROUP BY 1, 2)
SELECT * FROM op WHERE window_end - 1 > (SELECT max(ms) - 61000 FROM l)""",
        "topn_retract_changelog": _LATENESS
        + """, w AS (
  SELECT o.window_end AS o_end, coalesce(o.window_end, n.window_end) AS window_end,
         coalesce(o.rk, n.rk) AS rk, o.url AS o_url, o."count" AS o_count, n.url, n."count",
         n.window_end AS n_end
  FROM (SELECT * FROM v1 WHERE window_end IN (SELECT window_end FROM ch)) o
  FULL JOIN (SELECT * FROM v2 WHERE window_end IN (SELECT window_end FROM ch)) n
    ON o.window_end = n.window_end AND o.rk = n.rk
  WHERE o.url IS DISTINCT FROM n.url OR o."count" IS DISTINCT FROM n."count")
SELECT true AS is_add, window_end, rk, url, "count", 3 AS seq FROM v1
UNION ALL SELECT false, window_end, rk, o_url, o_count, 4 FROM w WHERE o_end IS NOT NULL
UNION ALL SELECT true, window_end, rk, url, "count", 5 FROM w WHERE n_end IS NOT NULL""",
        "topn_retract_materialize": _LATENESS + "SELECT * FROM v2",
        "pv_retract_changelog": _BASE + _PARTIALS + "SELECT * FROM c",
        "pv_retract_materialize": _TABLE_TOTALS,
        "hot_items_report": _ITEMS
        + f"""SELECT window_end, '===============' || chr(10) || {_TIME} || chr(10) ||
             string_agg('No ' || rk || ':  商品ID:' || item_id || '  浏览量:' || "count"
                        || chr(10), '' ORDER BY rk)
             || '===============' || chr(10) || chr(10) AS report FROM it GROUP BY 1""",
        "hot_urls_report": _URLS
        + f"SELECT window_end, {_URL_REPORT} AS report FROM ut GROUP BY 1",
        "pv_report": _BASE
        + _TOTALS
        + f"""SELECT window_end, '==================' || chr(10) || {_TIME} || ':' || chr(10)
             || 'PV次数:' || "count" AS report FROM t""",
        "hot_items_stream": _TOP_ITEMS,
        "hot_urls_stream": _TOP_URLS,
        "hot_urls_table_stream": _TABLE_ROWS,
        "hot_urls_late_stream": _TOP_URLS,
        "hot_urls_firings_stream": _ARRIVING
        + """SELECT window_end, CAST(dense_rank() OVER (PARTITION BY window_end ORDER BY fired)
                                 AS INTEGER) AS version, rk, url, "count" FROM rf""",
        "hot_urls_late_output_stream": _ARRIVING
        + """SELECT event_id, url, ms AS event_ms FROM ba JOIN wa USING (batch)
             WHERE method = 'GET' AND (ms // 5000) * 5000 + 600000 - 1 + 60000 <= wm""",
        "pv_stream": _PLAIN,
        "pv_changes_stream": _TABLE_TOTALS,
    }
