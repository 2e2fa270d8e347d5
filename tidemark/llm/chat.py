"""Chat formatting by a grammar round trip: what is rendered is parsed and compared.

Grammar. A formatted conversation is a sequence of turns and nothing else:

    user       [INST]body[/INST]
    system     [SYS]body[/SYS]
    assistant  <s>body</s>
    any other  [ROLE]body[/ROLE]body[/TURN]      the first body is the role

The nine control strings stand nowhere but there: a body with one in it is no body. The
parser is deterministic: bodies are possessive and end at the next control string. Inside
a control string, backslashes after its first character are escapes; the parser takes one
of them off.

Round trip. A turn is rendered as it is, parsed, and the recovered role and text compared
to the source. Where they differ (control strings cannot be parsed, and escapes would
lose a backslash), one more part is escaped, the text first, then the role too, until
both are identical. Turns are closed by control strings that no body holds, so turns that
survive by themselves survive in a row; the formatted conversation is parsed once more and
its turns compared to those it was made of, and a difference fails the job.

Rounds work on single turns, before any shuffle. One shuffle by conversation follows; a
conversation becomes one row, as the formatted text is one value (2 GB in Spark at most).
Only DataFrame functions are used.

Defined cases. Null roles and texts are empty. Turns stand by turn number, nulls first,
ties by role and text; a repeated row is a turn of its own. Rows without conversation id
are one conversation, with a null id. An empty table gives no rows. Extra columns may have
any name and are not returned.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import col, text_of

# The control strings.
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("<s>", "</s>")}
ROLE, ROLE_END, TURN_END = "[ROLE]", "[/ROLE]", "[/TURN]"

CONTROL = sorted({m for pair in MARKS.values() for m in pair} | {ROLE, ROLE_END, TURN_END})
#: The role whose texts a model learns to say.
LEARNED = "assistant"

_BODY = rf"(?:[^<\[]++|(?!{'|'.join(map(re.escape, CONTROL))})[<\[])*+"
_TURN = "|".join(
    [re.escape(a) + _BODY + re.escape(z) for a, z in MARKS.values()]
    + [re.escape(ROLE) + _BODY + re.escape(ROLE_END) + _BODY + re.escape(TURN_END)]
)


def _after_first(tail: str) -> str:
    """Places behind the first character of a control string, backslashes or not."""
    kinds = []
    for first in "<[":
        rest = "|".join(re.escape(c[1:]) for c in CONTROL if c[0] == first)
        kinds.append(rf"(?<={re.escape(first)}){tail}(?=\\*+(?:{rest}))")
    return "|".join(kinds)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_after_first("")), F.lit(r"\\"))


def unescaped(body: Column) -> Column:
    return F.regexp_replace(body, F.lit(_after_first(r"\\")), F.lit(""))


def _by_mark(value, is_it, otherwise: Column) -> Column:
    """``value(start, end)`` of the first kind of turn for which ``is_it``."""
    found = otherwise
    for name, (start, end) in MARKS.items():
        found = F.when(is_it(name, start), value(start, end)).otherwise(found)
    return found


def _rendered(role: Column, role_body: Column, body: Column) -> Column:
    def named(name: str, _: str) -> Column:
        return role == name

    start = F.concat(F.lit(ROLE), role_body, F.lit(ROLE_END))
    return F.concat(
        _by_mark(lambda a, _: F.lit(a), named, start),
        body,
        _by_mark(lambda _, z: F.lit(z), named, F.lit(TURN_END)),
    )


def turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, each as it stands there."""
    return F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))


def parsed_turn(block: Column) -> Column:
    """``role`` and ``text`` of one of :func:`turns`."""

    def begun(_: str, start: str) -> Column:
        return block.startswith(start)

    role_end = F.instr(block, ROLE_END)
    before = _by_mark(lambda a, _: F.lit(len(a)), begun, role_end - 1 + len(ROLE_END))
    after = _by_mark(lambda _, z: F.lit(len(z)), begun, F.lit(len(TURN_END)))
    role = unescaped(F.substring(block, F.lit(len(ROLE) + 1), role_end - 1 - len(ROLE)))
    for name, (start, _) in MARKS.items():
        role = F.when(block.startswith(start), F.lit(name)).otherwise(role)
    body = F.substring(block, before + 1, F.char_length(block) - before - after)
    return F.struct(role.alias("role"), unescaped(body).alias("text"))


def parsed(formatted: Column) -> Column:
    """``role`` and ``text`` of every turn of a formatted conversation, in order."""
    return F.transform(turns(formatted), parsed_turn)


def _round_trip(rows: DataFrame) -> DataFrame:
    """``rows`` with ``block``: the first rendering that is parsed to its own source.

    Each step is a column of its own, so that nothing is computed twice.
    """
    done = rows.select(
        "*",
        F.col("role").alias("role_body"),
        F.col("text").alias("body"),
        F.lit(None).cast("string").alias("block"),
    )
    for more in (None, "body", "role_body"):
        if more:
            done = done.withColumn(
                more, F.when(F.col("block").isNull(), escaped(F.col(more))).otherwise(F.col(more))
            )
        done = done.withColumn(
            "tried",
            F.when(F.col("block").isNull(), _rendered(*map(F.col, ("role", "role_body", "body")))),
        )
        done = done.withColumn("whole", turns(F.col("tried")) == F.array("tried"))
        done = done.withColumn("got", F.when(F.col("whole"), parsed_turn(F.col("tried"))))
        same = (F.col("got.role") == F.col("role")) & (F.col("got.text") == F.col("text"))
        done = done.withColumn("block", F.coalesce("block", F.when(same, F.col("tried"))))
    return done.drop("role_body", "body", "tried", "whole", "got")


def formatted(
    df: DataFrame,
    id_column: str,
    turn_column: str,
    role_column: str,
    text_column: str,
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_mask``.

    The mask lists the bodies to learn, in order: the ``turn`` (from 0) that holds it, the
    ``offset`` of this turn in ``formatted``, where the body starts within the turn, and
    its ``length``, all in code points. So a body starts at ``offset + start``.
    """
    rows = df.select(
        col(id_column).alias("conv_id"),
        col(turn_column).alias("turn"),
        text_of(col(role_column)).alias("role"),
        text_of(col(text_column)).alias("text"),
    )
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    start, end = MARKS[LEARNED]
    learned = F.struct(
        (F.col("number") - 1).cast("long").alias("turn"),
        "offset",
        F.lit(len(start)).cast("long").alias("start"),
        (F.col("n_chars") - len(start) - len(end)).alias("length"),
    )
    placed = (
        _round_trip(rows)
        .withColumn("n_chars", F.char_length("block").cast("long"))
        .select(
            "conv_id",
            "role",
            "block",
            "n_chars",
            F.row_number().over(in_order).alias("number"),
            F.coalesce(F.sum("n_chars").over(before), F.lit(0)).alias("offset"),
        )
        .select(
            "conv_id",
            "number",
            F.coalesce("block", F.raise_error(F.lit("a turn is not parsed to its source")))
            .alias("block"),
            F.when(F.col("role") == LEARNED, learned).alias("learned"),
        )
    )
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("number", "block", "learned"))).alias("turns")
    )
    joined = whole.select(
        "conv_id",
        F.array_join("turns.block", "").alias("formatted"),
        F.col("turns.block").alias("blocks"),
        F.filter("turns.learned", lambda x: x.isNotNull()).alias("loss_mask"),
    )
    return joined.select(
        "conv_id",
        F.when(turns(F.col("formatted")) == F.col("blocks"), F.col("formatted"))
        .otherwise(F.raise_error(F.lit("a conversation is not parsed to its turns")))
        .alias("formatted"),
        "loss_mask",
    )


def learned_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped, in order, with nothing between."""
    blocks = turns(formatted)
    return F.array_join(
        F.transform(
            loss_mask,
            lambda m: unescaped(
                F.substring(F.get(blocks, m["turn"].cast("int")), m["start"].cast("int") + 1,
                            m["length"].cast("int"))
            ),
        ),
        "",
    )
