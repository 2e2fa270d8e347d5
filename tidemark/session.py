"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

_DEFAULTS = {
    # Window ends, access-log times and report times are all read in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # RocksDB holds state outside the JVM heap and uploads only what changed;
    # keyed processors need it.
    _STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    """Create a session. ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(_DEFAULTS)
    settings.update({name.replace("__", "."): str(value) for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Fix the session zone on a session somebody else built."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def pin_state_store(spark: SparkSession) -> SparkSession:
    """Queries started from now on keep their state in RocksDB, whoever built the session."""
    spark.conf.set(_STATE_STORE, _DEFAULTS[_STATE_STORE])
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
