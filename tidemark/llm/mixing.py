"""Mixing sources to target weights: tempered shares, drawn as block permutations.

A source's weight is its share of all tokens to the power ``alpha``, normalised. A lower
``alpha`` flattens the mix. It is bisected to the lowest value at which no source is
repeated more than ``max_repeats`` times within the budget, or, with ``target_entropy``,
to the value whose weights have that entropy in nats (both: the larger of the two). Each
step needs sums over the table of sources only; several steps of the bisection are
evaluated per pass, and the driver gets one number for each.

A source's budget is its weight times the token budget. It is spent on permutations of
the source's documents, a new one for each epoch, until a document would begin at or
behind the budget. The stream is cut into blocks of ``block_tokens``, each of which holds
every source by its weight: a copy goes to the block that its position in its source's
sequence falls into, and has a random place there (``block_order``).

Defined cases. A null source is a source of its own. A null or empty text has no tokens;
its document is drawn where its position lies below the budget. A source without tokens
has weight zero and is not drawn. The order hashes the epoch, the id and a digest of the
text, so rows that share an id are permuted like others; equal rows are told apart by the
order in which they were written. Rows without an id are named by that order. A budget beyond ``max_repeats`` times the corpus cannot be met:
``ValueError``. Without any tokens no rows come out. Texts of any length count whole.
Extra columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.prefix_sums import before
from tidemark.llm.rows import col, field, packed, text_of, word_count
from tidemark.workspace import may_broadcast, write_table

#: Steps of the bisection, and how many of them one pass evaluates.
STEPS, STEPS_PER_PASS = 30, 5
SEED = 11


@dataclass(frozen=True)
class Target:
    """What the mix should meet. ``budget`` is the output's tokens over the input's."""

    max_repeats: float | None = 4.0
    target_entropy: float | None = None
    budget: float = 1.0
    block_tokens: int = 1 << 16


def _bisected(sources: DataFrame, met, low_if_met: bool) -> float:
    """Bisect ``alpha`` in [0, 1]; ``met`` makes a condition of ``alpha`` over all sources."""
    low, high = 0.0, 1.0
    for _ in range(STEPS // STEPS_PER_PASS):
        parts = 1 << STEPS_PER_PASS
        middles = [low + (high - low) * i / parts for i in range(1, parts)]
        # Named by their place in the tree of possible steps.
        answers = sources.agg(*[met(a).alias(str(i)) for i, a in enumerate(middles, 1)]).first()
        left, right = 0, parts
        while right - left > 1:
            middle = (left + right) // 2
            if answers[middle - 1] == low_if_met:
                right = middle
            else:
                left = middle
        low, high = low + (high - low) * left / parts, low + (high - low) * right / parts
    return high


def weights(sources: DataFrame, target: Target) -> tuple[float, DataFrame, float]:
    """``(alpha, sources with weight, total tokens)`` for ``sources``: ``key, tokens, docs``."""
    known = sources.where("tokens > 0")
    total, largest, least, n = known.agg(
        F.sum("tokens"), F.max("tokens"), F.min("tokens"), F.count("*")
    ).first()
    if not n:
        return 1.0, known.withColumn("weight", F.lit(0.0)), 0
    if target.max_repeats is not None and target.budget > target.max_repeats:
        raise ValueError("the budget repeats the whole corpus more often than max_repeats")
    share = F.col("tokens") / F.lit(float(largest))

    def power(alpha: float) -> Column:
        return F.pow(share, F.lit(alpha))

    def repeats_allowed(alpha: float) -> Column:
        # The source with the fewest tokens is repeated most.
        smallest = F.pow(F.lit(least / largest), F.lit(alpha))
        repeats = smallest / F.sum(power(alpha)) * F.lit(target.budget * total / least)
        return repeats <= F.lit(float(target.max_repeats))

    def too_flat(alpha: float) -> Column:
        scale = F.sum(power(alpha))
        entropy = F.log(scale) - F.sum(power(alpha) * F.log(power(alpha))) / scale
        return entropy <= F.lit(float(target.target_entropy))

    alpha = 0.0
    if target.max_repeats is not None:
        alpha = _bisected(known, repeats_allowed, True)
    if target.target_entropy is not None:
        alpha = max(alpha, _bisected(known, too_flat, True))
    scale = known.agg(F.sum(power(alpha))).first()[0]
    return alpha, known.withColumn("weight", power(alpha) / F.lit(scale)), total


def _key(*parts: Column) -> Column:
    """60 bits of an MD5 as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 15), 16, 10).cast("long")


def mixed(rows: DataFrame, target: Target, seed: int = SEED) -> DataFrame:
    """Draw rows ``uid, source, id, tokens, digest`` of a written table.

    Adds ``epoch``, ``position`` (tokens of the source's sequence before the copy),
    ``block`` and ``block_order``; a row comes out once per epoch that draws it.
    """
    keyed = rows.withColumn(
        "source_key",
        F.when(F.col("source").isNull(), "null").otherwise(
            F.concat(F.lit("="), F.col("source").cast("string"))
        ),
    )
    sources, _ = write_table(
        keyed.groupBy(F.col("source_key").alias("key")).agg(
            F.sum("tokens").alias("tokens"), F.count("*").alias("docs")
        ),
        "sources",
    )
    _, weighted, total = weights(sources, target)
    plan = weighted.select(
        "key",
        "weight",
        F.col("tokens").alias("source_tokens"),
        F.col("docs").alias("source_docs"),
        F.floor(F.col("weight") * F.lit(float(target.budget * total))).alias("source_budget"),
    )
    plan, _ = write_table(plan, "weights")
    side = F.broadcast(plan) if may_broadcast(plan.count(), 200) else plan
    epochs = F.sequence(
        F.lit(0).cast("long"), F.floor(F.col("source_budget") / F.col("source_tokens"))
    )
    copies = (
        keyed.join(side, F.col("source_key") == F.col("key"))
        .drop("key")
        .withColumn("epoch", F.explode(epochs))
    )
    name = F.coalesce(
        F.col("id").cast("string"), F.concat(F.lit("null/"), F.col("uid").cast("string"))
    )
    named = [F.col("epoch").cast("string"), F.col("id_name"), F.col("digest")]
    ordered = copies.withColumn("id_name", name).withColumn(
        "order_key", _key(F.lit(str(seed)), *named)
    )
    placed = before(
        ordered,
        ["source_key", "epoch"],
        "order_key",
        ["id_name", "digest", "uid"],
        "tokens",
        "source_docs",
    )
    position = F.col("epoch") * F.col("source_tokens") + F.col("before")
    per_block = F.col("weight") * F.lit(float(target.block_tokens))
    return (
        placed.withColumn("position", position)
        .where(F.col("position") < F.col("source_budget"))
        .withColumn("block", F.floor(F.col("position") / per_block))
        .withColumn("block_order", _key(F.lit(f"{seed}b"), *named))
        .drop(
            "source_key", "weight", "source_tokens", "source_docs", "source_budget",
            "order_key", "id_name", "before",
        )
    )


def _narrow(rows: DataFrame, uid: Column, source: Column, id_: Column, text: Column) -> DataFrame:
    return rows.select(
        uid.alias("uid"),
        source.alias("source"),
        id_.alias("id"),
        word_count(text).alias("tokens"),
        F.md5(text_of(text)).alias("digest"),
    )


def drawn(
    df: DataFrame, id_column: str, text_column: str, source_column: str, target: Target = Target()
) -> DataFrame:
    """``doc_id, source, n_tokens, epoch, position, block, block_order`` of every copy."""
    narrow = _narrow(
        df, F.monotonically_increasing_id(), col(source_column), col(id_column), col(text_column)
    )
    rows, _ = write_table(narrow, "tokens")
    return mixed(rows, target).select(
        F.col("id").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"),
        "epoch", "position", "block", "block_order",
    )


def drawn_rows(
    df: DataFrame, id_column: str, text_column: str, source_column: str, target: Target = Target()
) -> DataFrame:
    """The rows of ``df`` that the mix draws, all columns kept, once per copy.

    Rows are drawn by number; whole rows meet their numbers in one join.
    """
    whole, _ = write_table(
        packed(df).withColumn("uid", F.monotonically_increasing_id()), "rows"
    )
    narrow = _narrow(
        whole, F.col("uid"), field(source_column), field(id_column), field(text_column)
    )
    rows, _ = write_table(narrow, "tokens")
    copies = mixed(rows, target).groupBy(F.col("uid").alias("d_uid")).agg(
        F.count("*").cast("int").alias("copies")
    )
    return (
        whole.join(copies, F.col("uid") == F.col("d_uid"))
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
        .select("row.*")
    )
