"""Text lines to records, as column expressions.

One pattern per format says whether a line is well formed. ``parse_*`` end the
job on the first line that is not, also in queries that use none of its fields;
``split_*`` give good records and bad lines as two DataFrames.

Fields past the last used one are ignored, and separators at the very end of a
line do not open another (empty) field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at_most(bound: int) -> str:
    """Pattern of the unsigned decimal numbers up to ``bound``."""
    digits = str(bound)
    parts = [f"[0-9]{{1,{len(digits) - 1}}}"]
    for i, digit in enumerate(digits):
        if digit != "0":
            rest = len(digits) - i - 1
            parts.append(f"{digits[:i]}[0-{int(digit) - 1}][0-9]{{{rest}}}")
    parts.append(digits)
    return f"0*(?:{'|'.join(parts)})"


def _signed(bits: int) -> str:
    return rf"(?:\+?{_at_most(2 ** (bits - 1) - 1)}|-{_at_most(2 ** (bits - 1))})"


_LONG, _INT = _signed(64), _signed(32)
_BEHAVIOR = f"^{_LONG},{_LONG},{_INT},[^,]*,{_LONG}(?:,|$)"

# Parts of a time may be far past their range. So many digits keep the sum a LONG.
_PART, _YEAR = "0*[0-9]{1,9}", "0*[0-9]{1,7}"
_TIME = f"{_PART}/{_PART}/{_YEAR}:{_PART}:{_PART}:{_PART}(?![0-9])[^ ]*"
# Days from 1 March of the year -400 to 1 January 1970.
_EPOCH_DAYS = 865565
_ACCESS_LOG = f"^[^ ]* [^ ]* [^ ]* {_TIME} [^ ]* [^ ]* (?=.*[^ ])"


def _well_formed(pattern: str) -> Column:
    return F.col("value").rlike(pattern)


def _checked_tokens(lines: DataFrame, pattern: str, tokens: Column, what: str) -> DataFrame:
    """Tokens of each line as ``_t``, or the end of the job.

    One array in, one row out: the optimizer neither drops a generator nor
    copies it into the filters and projections above, so every line is checked
    and cut exactly once.
    """
    stop = F.raise_error(F.concat(F.lit(f"malformed {what} line: "), F.col("value")))
    checked = F.when(_well_formed(pattern), tokens).otherwise(stop.cast("array<string>"))
    return lines.select(F.explode(F.array(checked)).alias("_t"))


def _token(i: int) -> Column:
    return F.get("_t", F.lit(i))


def _behavior_tokens() -> Column:
    return F.split("value", ",", 6)


def _behavior_fields(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        _token(0).cast("long").alias("user_id"),
        _token(1).cast("long").alias("item_id"),
        _token(2).cast("int").alias("category_id"),
        _token(3).alias("behavior"),
        _token(4).cast("long").alias("timestamp"),
    )


def _access_log_tokens() -> Column:
    return F.split("value", " ", 8)


def _access_log_fields(tokens: DataFrame) -> DataFrame:
    # The parts of the time are bound by a projection of their own: they are
    # used six times above.
    parts = F.split(F.translate(_token(3), "/", ":"), ":", 6)
    return tokens.withColumn("_p", parts).select(
        _token(0).alias("ip"),
        _token(1).alias("user_id"),
        _civil_ms().alias("event_time"),
        _token(5).alias("method"),
        _token(6).alias("url"),
    )


def _civil_ms() -> Column:
    """Epoch ms (UTC) of the time parts day, month, year, hour, minute, second.

    Parts past their range carry over: 32/01 is 1 February. Text after the
    seconds is ignored.
    """

    def part(i: int) -> Column:
        return F.get("_p", F.lit(i)).cast("long")

    def div(value: Column, by: int) -> Column:
        """Floor division, which Spark's ``div`` is for values from 0 on."""
        return F.call_function("div", value, F.lit(by).cast("long"))

    second = F.regexp_extract(F.get("_p", F.lit(5)), "^[0-9]+", 0).cast("long")
    # Years begin in March here, so that a leap day ends its year, and are counted from
    # 400 years earlier, so that the number is positive.
    months = (part(2) + 400) * 12 + part(1) - 3
    year, month = div(months, 12), F.pmod(months, F.lit(12).cast("long"))
    leap_days = div(year, 4) - div(year, 100) + div(year, 400)
    first = year * 365 + leap_days + div(month * 153 + 2, 5)
    days = first + part(0) - 1 - F.lit(_EPOCH_DAYS)
    return (((days * 24 + part(3)) * 60 + part(4)) * 60 + second) * 1000


def parse_behavior(lines: DataFrame) -> DataFrame:
    """``user,item,category,behavior,epoch-seconds`` lines, failing on bad ones."""
    return _behavior_fields(
        _checked_tokens(lines, _BEHAVIOR, _behavior_tokens(), "behavior")
    )


def split_behavior(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed records and, apart from them, the lines that do not parse."""
    good = lines.where(_well_formed(_BEHAVIOR))
    bad = lines.where(~_well_formed(_BEHAVIOR)).select("value")
    return _behavior_fields(good.select(_behavior_tokens().alias("_t"))), bad


def parse_access_log(lines: DataFrame) -> DataFrame:
    """Space-separated access-log lines, failing on bad ones.

    Tokens: 0 ip, 1 user, 3 time (``dd/MM/yyyy:HH:mm:ss``), 5 method, 6 url.
    Token 4 (the zone) is not used; times are UTC.
    """
    return _access_log_fields(
        _checked_tokens(lines, _ACCESS_LOG, _access_log_tokens(), "access-log")
    )


def split_access_log(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed records and, apart from them, the lines that do not parse."""
    good = lines.where(_well_formed(_ACCESS_LOG))
    bad = lines.where(~_well_formed(_ACCESS_LOG)).select("value")
    return _access_log_fields(good.select(_access_log_tokens().alias("_t"))), bad
