"""Fill-in-middle: texts cut into prefix, middle and suffix, put in another order.

A text is a sequence of units: a run of ASCII letters, or any other code point by itself.
``regexp_count`` gives their number n. Two draws from a hash of the row's id place the
cuts after a and b units, a <= b. The row's own pattern, ``unit{a}`` and ``unit{b-a}`` as
possessive groups and the rest, then matches the whole text once, and the replacement of
this one match is the output. Possessive groups never backtrack and take no stack, so a
match is linear in the text. Only Spark's regular expressions are used, no Python.

Forms. ``psm`` is prefix mark, prefix, suffix mark, suffix, middle mark, middle; ``spm``
has suffix mark and suffix first, then prefix mark and prefix, then middle mark and
middle; ``plain`` is the text as it is. A text with a mark in it is plain: so the marks of
an output are its own, and :func:`restored` gives the text back from output and form.

Defined cases. A null or empty text is the empty plain output. A null id draws like an
empty one. Repeated rows and rows that share an id draw alike; each gives its own row.
Whole texts are matched, however long. An empty table gives no rows. Extra columns may
have any name and are not returned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import col, text_of

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The same units; what a possessive run has taken it keeps.
_POSSESSIVE_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"


@dataclass(frozen=True)
class Plan:
    """What is drawn how often, and the marks. Percentages are of a hash's remainder."""

    seed: str = "1"
    changed_percent: int = 90
    spm_percent: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        # A mark that another one's end could complete would be found in a wrong place.
        for mark in self.marks:
            if not (len(mark) > 2 and mark[0] == "<" and mark[-1] == ">"
                    and not set("<>") & set(mark[1:-1])):
                raise ValueError(f"a mark is <, one or more other characters, >: {mark!r}")
        if len(set(self.marks)) < 3:
            raise ValueError("the three marks must differ")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _draws(id_: Column, seed: str) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), text_of(id_)), 256)
    return [
        F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)
    ]


def _replacement(*parts: str) -> str:
    """Marks and ``$n`` groups as a replacement text; marks are taken literally."""
    return "".join(
        p if re.fullmatch(r"\$\d", p) else p.replace("\\", "\\\\").replace("$", "\\$")
        for p in parts
    )


def _cut_pattern(units: Column, more: Column) -> Column:
    counted = f"({_POSSESSIVE_UNIT}{{"
    return F.concat(
        F.lit(rf"\A{counted}"), units.cast("string"),
        F.lit(f"}}+){counted}"), more.cast("string"),
        F.lit(r"}+)([\s\S]*+)\z"),
    )


def _between_marks(output: Column, plan: Plan) -> Column:
    """The three parts of an output that is not plain, in its own order."""
    return F.split(output, "|".join(re.escape(m) for m in plan.marks))


def restored(output: Column, form: Column, plan: Plan = Plan()) -> Column:
    """The text that gave ``output`` in this ``form``."""
    parts = _between_marks(output, plan)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def transformed(
    df: DataFrame, id_column: str, text_column: str, plan: Plan = Plan()
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n, form, prefix, middle, suffix, output``.

    The three parts are null in plain rows.
    """
    draws = _draws(F.col("doc_id"), plan.seed)
    marked = F.lit(False)
    for mark in plan.marks:
        marked = marked | F.contains("text", F.lit(mark))
    rows = df.select(col(id_column).alias("doc_id"), text_of(col(text_column)).alias("text"))
    counted = rows.select(
        "doc_id",
        "text",
        F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
        *[draw.alias(f"h{i}") for i, draw in enumerate(draws, 1)],
        F.when((F.col("text") == "") | marked, "plain").alias("form"),
    )
    first, second = (F.col(h) % (F.col("n") + 1) for h in ("h1", "h2"))
    placed = counted.select(
        "doc_id",
        "text",
        "n",
        F.least(first, second).alias("a"),
        F.greatest(first, second).alias("b"),
        F.coalesce(
            "form",
            F.when(F.col("h3") % 100 >= plan.changed_percent, "plain")
            .when(F.col("h4") % 100 < plan.spm_percent, "spm")
            .otherwise("psm"),
        ).alias("form"),
    )
    order = F.when(
        F.col("form") == "spm", _replacement(plan.suffix, "$3", plan.prefix, "$1", plan.middle, "$2")
    ).otherwise(_replacement(plan.prefix, "$1", plan.suffix, "$3", plan.middle, "$2"))
    matched = placed.select(
        "doc_id",
        "n",
        "form",
        F.when(F.col("form") == "plain", F.col("text"))
        .otherwise(
            F.regexp_replace("text", _cut_pattern(F.col("a"), F.col("b") - F.col("a")), order)
        )
        .alias("output"),
    )
    parts = matched.withColumn(
        "parts", F.when(F.col("form") != "plain", _between_marks(F.col("output"), plan))
    )
    spm = F.col("form") == "spm"
    return parts.select(
        "doc_id",
        "n",
        "form",
        F.when(spm, F.col("parts")[2]).otherwise(F.col("parts")[1]).alias("prefix"),
        F.col("parts")[3].alias("middle"),
        F.when(spm, F.col("parts")[1]).otherwise(F.col("parts")[2]).alias("suffix"),
        "output",
    )
