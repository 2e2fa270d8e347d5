"""Removal of byte strings that occur twice, by merged Burrows-Wheeler transforms.

Every byte covered by a ``length``-byte string that starts anywhere else too is removed.

*Anchors.* Each window of ``length`` bytes has an anchor: the ``GRAM``-byte gram with the
least hash in it. Equal windows have equal anchors, so windows are only ever compared
with those of the same anchor gram. Windows with one anchor are a run of starts; a run's
bytes are a snippet. Grams that occur once leave nothing to compare. Copies of a snippet,
by gram and a digest of 128 bits, are counted before anything is shuffled. What is left
are distinct snippets that share a gram, each with a weight.

*Merged transforms.* A task takes whole grams' snippets, some megabytes at a time, in
shards. A snippet is read as interleaved sequences of ``LETTER``-byte letters, one for each
phase, so that every byte position starts a suffix of letters. Each shard's suffixes are
sorted once and give its transform. The shards' transforms are then merged by refining
their interleave: after round *i* the suffixes of all shards stand in the order of their
first *i* letters, and a boundary that appears in round *i* between two neighbours says
that they share *i* - 1 letters. After ``length / LETTER`` rounds neighbours without a
boundary are equal windows: a repeated interval. No suffix is sorted again. Letters are
named by hashes, so the windows of an interval are compared byte by byte at last.

A gram with more distinct snippets than ``crowd`` is not gathered in one task: its
windows are counted by digest instead, spread over all tasks.

Texts meet their snippets and spans by shuffled joins at every size: both sides grow with
the corpus. Rows are numbered once, in a table that every later step reads: a number given
anew at each reading would follow the reading's partitions. Snippets are checked against
their digest when they are cut.

Defined cases. A null text is empty. Texts shorter than ``length`` lose nothing. Rows
that are repeated, or share an id, are texts of their own, so a repeated row with a text
of ``length`` bytes or more loses all of it. Very long texts are cut into slices that
overlap by ``length`` - 1 bytes, which loses no window. An empty table gives no rows.
Extra columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import col, text_of
from tidemark.workspace import write_table

LENGTH = 400
GRAM = 64
LETTER = 80
#: Distinct snippets of one gram that a task takes at once.
CROWD = 3000
#: Positions merged at once, and those of a shard, about.
BATCH_POSITIONS, SHARD_POSITIONS = 1 << 20, 1 << 19

_SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(3).integers(0, 1 << 63, 256).astype(np.uint64)
_POSITION = np.uint64((1 << 24) - 1)


def _mixed(found: np.ndarray) -> np.ndarray:
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0x94D049BB133111EB)
    return found ^ (found >> np.uint64(32))


class _Rolling:
    """Hashes of all grams of a text, from prefix sums modulo 2^64."""

    def __init__(self) -> None:
        n = _SLICE + 2 * LENGTH + 1
        self._up = np.ones(n, dtype=np.uint64)
        self._down = np.ones(n, dtype=np.uint64)
        self._up[1:] = np.uint64(_BASE)
        self._down[1:] = np.uint64(_BASE_INVERSE)
        np.multiply.accumulate(self._up, out=self._up)
        np.multiply.accumulate(self._down, out=self._down)

    def grams(self, data: np.ndarray, n: int) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_CODES[data] * self._up[: len(data)], out=sums[1:])
        return _mixed((sums[n:] - sums[:-n]) * self._down[: len(data) - n + 1])


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by minima from both ends of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _runs(data: np.ndarray, rolling: _Rolling, length: int) -> tuple[np.ndarray, ...]:
    """``(first start, last start, gram hash)`` of each run of windows with one anchor."""
    hashes = rolling.grams(data, GRAM)
    order = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    anchors = _window_minima(order, length - GRAM + 1) & _POSITION
    change = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change - 1, [len(anchors) - 1]))
    return first, last, hashes[anchors[first].astype(np.int64)]


def _slices(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    for at in range(0, max(1, len(text) - length + 1), _SLICE):
        yield at, text[at : at + _SLICE + length - 1]


_digest = xxhash.xxh3_128_digest


def _snippets(length: int):
    """One row per run of a text: ``uid, gram, d1, d2, first, last``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = _Rolling()
        for batch in batches:
            uids, texts = batch.column("uid").to_pylist(), batch.column("text").cast(pa.binary())
            out: list[list] = [[], [], [], [], [], []]
            for uid, value in zip(uids, texts):
                text = value.as_py()
                if len(text) < length:
                    continue
                for at, part in _slices(text, length):
                    first, last, gram = _runs(np.frombuffer(part, dtype=np.uint8), rolling, length)
                    digest = b"".join(
                        _digest(part[a : b + length]) for a, b in zip(first.tolist(), last.tolist())
                    )
                    halves = np.frombuffer(digest, dtype=">i8").astype(np.int64).reshape(-1, 2)
                    found = (np.full(len(first), uid), gram.view(np.int64), halves[:, 0], halves[:, 1],
                             first + at, last + at)
                    for column, values in zip(out, found):
                        column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out],
                    names=["uid", "gram", "d1", "d2", "first", "last"],
                )

    return find


# -- merged transforms -----------------------------------------------------------


def _letters(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A dense name for the ``LETTER`` bytes at each position, fewer at a snippet's end.

    ``left`` holds the bytes left in the position's snippet. Names are those of a 64-bit
    hash of the bytes and their number, in the order of the hashes.
    """
    n, width = len(data), np.minimum(left, LETTER)
    up, down = (np.full(n + 1, b, dtype=np.uint64) for b in (_BASE, _BASE_INVERSE))
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_CODES[data] * up[:n], out=sums[1:])
    mixed = _mixed((sums[np.arange(n) + width] - sums[:n]) * down[:n] + width.astype(np.uint64))
    order = np.argsort(mixed)
    ranked = mixed[order]
    names = np.empty(n, dtype=np.int64)
    names[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
    return names


class _Shard:
    """The suffixes of some snippets in order, and the letter before each of them.

    Suffixes are numbered like the positions; behind them comes the empty suffix of each
    sequence, which sorts before all others, in the order of the sequences.
    """

    def __init__(self, names: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        n = len(names)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(n) - starts[owner]
        phases = np.minimum(sizes, LETTER)
        first_of = np.concatenate(([0], np.cumsum(phases)))
        ends = int(first_of[-1])
        sequence = first_of[owner] + inside % LETTER
        follows = np.where(inside + LETTER < sizes[owner], np.arange(n) + LETTER, n + sequence)
        after = np.concatenate((follows, n + np.arange(ends)))
        rank = np.concatenate((ends + names, np.arange(ends)))
        self.order = _suffix_order(rank, after)
        before = np.zeros(n + ends, dtype=np.int64)  # 0: nothing stands before
        has = inside >= LETTER
        before[:n][has] = names[np.flatnonzero(has) - LETTER] + 1
        last = follows >= n
        before[follows[last]] = names[last] + 1
        self.before, self.ends = before[self.order], ends


def _dense(ordered: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))


def _suffix_order(rank: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the letters compared. All differ in the end."""
    n = len(rank)
    bits = np.uint64(max(n - 1, 1).bit_length())
    index = np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << int(bits)) - 1)
    # Names become ranks below n first.
    order = np.argsort(rank, kind="stable")
    rank_of = np.empty(n, dtype=np.uint64)
    rank_of[order] = _dense(rank[order]).astype(np.uint64)
    while True:
        key = ((rank_of << bits | rank_of[after]) << bits) | index
        key.sort()
        order = (key & low).astype(np.int64)
        ranked = _dense(key >> bits)
        if ranked[-1] == n - 1:
            return order
        rank_of[order] = ranked.astype(np.uint64)
        after = after[after]


def repeated_starts(snippets: list[bytes], windows: np.ndarray, weights: np.ndarray, length: int):
    """For each snippet, which of its first ``windows`` windows occur more than once.

    A window in a snippet of weight two counts twice. Returns one boolean array over the
    positions of all snippets, and where each snippet starts.
    """
    sizes = np.array([len(s) for s in snippets], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    whole = b"".join(snippets)
    data = np.frombuffer(whole, dtype=np.uint8)
    left = np.repeat(starts[1:], sizes) - np.arange(len(data))
    names = _letters(data, left)
    cuts = [0]
    for i in range(1, len(sizes) + 1):
        if i == len(sizes) or starts[i] - starts[cuts[-1]] >= SHARD_POSITIONS:
            cuts.append(i)
    shards = [
        _Shard(names[starts[a] : starts[b]], starts[a:b] - starts[a], sizes[a:b])
        for a, b in zip(cuts, cuts[1:])
    ]
    source, block = _interleaved(shards, length // LETTER)
    place = np.empty(len(source), dtype=np.int64)
    for number, (shard, a, b) in enumerate(zip(shards, cuts, cuts[1:])):
        size = starts[b] - starts[a]
        own = np.where(shard.order < size, shard.order + starts[a], -1)
        place[source == number] = own
    inside = np.arange(len(data)) - np.repeat(starts[:-1], sizes)
    starts_window = inside < np.repeat(windows, sizes)
    weight = np.where(starts_window, np.repeat(weights, sizes), 0)
    known = place >= 0
    known[known] = starts_window[place[known]]
    at, block = place[known], block[known]
    again = np.zeros(len(data), dtype=bool)
    if len(at):
        begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        members = np.diff(np.append(begins, len(at)))
        total = np.repeat(np.add.reduceat(weight[at], begins), members)
        first = np.repeat(np.minimum.reduceat(at, begins), members)
        again[at] = total >= 2
        for number in np.unique(block[_differing(whole, at, first, length)]):
            _by_bytes(whole, at[block == number], weight, length, again)
    return again, starts


def _differing(whole: bytes, at: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
    """Which windows differ from the first one of their block; stretches are compared at once."""
    order = np.argsort(at)
    order = order[at[order] != first[order]]
    a, b = at[order], first[order]
    cut = np.flatnonzero((np.diff(a) != 1) | (np.diff(b) != 1)) + 1
    wrong = [
        order[i:j]
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(a)])
        if j > i and whole[a[i] : a[j - 1] + length] != whole[b[i] : b[j - 1] + length]
    ]
    return np.concatenate(wrong) if wrong else np.zeros(0, dtype=np.int64)


def _by_bytes(whole: bytes, at: np.ndarray, weight: np.ndarray, length: int, again: np.ndarray):
    """A block that a hash has put together, counted anew by its bytes."""
    total: dict[bytes, int] = {}
    for i in at.tolist():
        window = whole[i : i + length]
        total[window] = total.get(window, 0) + int(weight[i])
    for i in at.tolist():
        again[i] = total[whole[i : i + length]] >= 2


def _interleaved(shards: list[_Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards' suffixes merged by their first ``rounds`` letters.

    Returns the shard of each suffix in merged order and its block: suffixes of a block
    agree in all those letters, and every change of block is a shorter common prefix.
    """
    sizes = [len(s.order) for s in shards]
    source = np.repeat(np.arange(len(shards), dtype=np.int8), sizes)
    block = np.zeros(len(source), dtype=np.int64)
    ends = np.repeat(np.arange(len(shards), dtype=np.int8), [s.ends for s in shards])
    index = np.arange(len(source), dtype=np.uint64)
    for _ in range(rounds):
        letter = np.empty(len(source), dtype=np.uint64)
        for number, shard in enumerate(shards):
            letter[source == number] = shard.before
        key = letter << np.uint64(32) | index
        key.sort()  # a stable sort by the letter before
        order = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        letter = key >> np.uint64(32)
        source, before = source[order], block[order]
        change = (letter[1:] != letter[:-1]) | (before[1:] != before[:-1])
        # Empty suffixes stand first, shard by shard, each a block of its own.
        change[: len(ends)] = True
        source[: len(ends)] = ends
        block = np.concatenate(([0], np.cumsum(change)))
    return source, block


def _merge(length: int):
    """Repeated windows of snippets that come sorted by gram."""

    def found(some: list[tuple]) -> pa.RecordBatch:
        again, starts = repeated_starts(
            [s[3] for s in some],
            np.array([s[4] for s in some]),
            np.array([s[5] for s in some]),
            length,
        )
        edges = np.diff(np.concatenate(([0], again.astype(np.int8), [0])))
        low, high = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
        # A run may not pass from one snippet to the next: snippets end with no window.
        owner = np.searchsorted(starts, low, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array(np.array([s[i] for s in some], dtype=np.int64)[owner]) for i in range(3)),
                pa.array(low - starts[owner]),
                pa.array(high - starts[owner]),
            ],
            names=["gram", "d1", "d2", "low", "high"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple] = []
        positions, gram = 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in _SNIPPET]
            for row in zip(*columns):
                if row[0] != gram and positions >= BATCH_POSITIONS:
                    yield found(some)
                    some, positions = [], 0
                some.append(row)
                gram, positions = row[0], positions + len(row[3])
        if some:
            yield found(some)

    return merge


# -- the whole --------------------------------------------------------------------


_SNIPPET = ["gram", "d1", "d2", "snippet", "windows", "weight"]
_SNIPPET_DDL = "gram long, d1 long, d2 long, snippet binary, windows long, weight int"


def _cut_out(length: int):
    """Snippets out of the texts that hold them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column("text").cast(pa.binary())
            for text, wanted in zip(texts, batch.column("wanted")):
                whole = text.as_py()
                for w in wanted.as_py():
                    snippet = whole[w["first"] : w["last"] + length]
                    told = w["d1"].to_bytes(8, "big", signed=True) + w["d2"].to_bytes(8, "big", signed=True)
                    if _digest(snippet) != told:
                        raise RuntimeError("a snippet is not where it was found")
                    out.append((w["gram"], w["d1"], w["d2"], snippet,
                                w["last"] - w["first"] + 1, w["weight"]))
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=_SNIPPET
            )

    return cut


def _windows(length: int):
    """Each window of a snippet by the digest of its bytes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in _SNIPPET]
            for gram, d1, d2, snippet, n, weight in zip(*columns):
                found = [_digest(snippet[i : i + length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([gram] * n), pa.array([d1] * n), pa.array([d2] * n),
                     pa.array(range(n), pa.int64()), pa.array(found, pa.binary()),
                     pa.array([weight] * n, pa.int32())],
                    names=["gram", "d1", "d2", "low", "window", "weight"],
                )

    return windows


def _crowded_windows(snippets: DataFrame, length: int) -> DataFrame:
    rows, _ = write_table(
        snippets.mapInArrow(
            _windows(length),
            "gram long, d1 long, d2 long, low long, window binary, weight int",
        ),
        "windows",
    )
    again, _ = write_table(
        rows.groupBy("window").agg(F.sum("weight").alias("n")).where("n > 1")
        .select(F.col("window").alias("again")),
        "windows",
    )
    return rows.join(again, F.col("window") == F.col("again")).select(
        "gram", "d1", "d2", "low", F.col("low").alias("high")
    )


def _merged_spans(found: list[tuple[int, int]], length: int) -> list[list[int]]:
    spans: list[list[int]] = []
    for low, high in sorted(found):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high + length)
        else:
            spans.append([low, high + length])
    return spans


_KEPT = "n_removed long, n_spans long, kept_sha256 string"


def _kept(texts: pa.Array, spans: pa.Array) -> pa.Array:
    removed, numbers, digests = [], [], []
    for value, own in zip(texts.cast(pa.binary()), spans.to_pylist()):
        text, at, gone, digest = value.as_py(), 0, 0, hashlib.sha256()
        for span in own or ():
            digest.update(text[at : span["low"]])
            at, gone = span["high"], gone + span["high"] - span["low"]
        digest.update(text[at:])
        removed.append(gone)
        numbers.append(len(own or ()))
        digests.append(digest.hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(removed, pa.int64()), pa.array(numbers, pa.int64()), pa.array(digests)],
        names=["n_removed", "n_spans", "kept_sha256"],
    )


def spans_to_remove(texts: DataFrame, length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """``(uid, spans)`` of the texts that lose bytes; ``texts`` holds ``uid, text``.

    ``texts`` is read twice and must give a row the same number both times.
    """
    found, _ = write_table(
        texts.mapInArrow(
            _snippets(length), "uid long, gram long, d1 long, d2 long, first long, last long"
        ),
        "snippets",
    )
    shared, _ = write_table(
        found.groupBy(F.col("gram").alias("s_gram")).agg(F.count("*").alias("n")).where("n > 1").drop("n"),
        "grams",
    )
    rows, _ = write_table(
        found.join(shared, F.col("gram") == F.col("s_gram")).drop("s_gram"), "snippets"
    )
    place = F.struct("uid", "first", "last")
    distinct = rows.groupBy("gram", "d1", "d2").agg(
        F.min(place).alias("place"), F.least(F.count("*"), F.lit(2)).cast("int").alias("weight")
    )
    wanted, _ = write_table(
        distinct.groupBy(F.col("place.uid").alias("w_uid")).agg(
            F.collect_list(
                F.struct("gram", "d1", "d2", "place.first", "place.last", "weight")
            ).alias("wanted")
        ),
        "snippets",
    )
    snippets, _ = write_table(
        texts.join(wanted.hint("shuffle_merge"), F.col("uid") == F.col("w_uid"))
        .select("text", "wanted")
        .mapInArrow(_cut_out(length), _SNIPPET_DDL),
        "snippets",
    )
    n = wanted.agg(F.coalesce(F.sum(F.size("wanted")), F.lit(0))).first()[0]
    grams = snippets.groupBy("gram").agg(F.count("*").alias("n"))
    n_cut, crowded = grams.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n") > crowd, F.lit(False))
    ).first()
    if n_cut != n:
        raise RuntimeError("the rows of the texts were numbered otherwise on a second reading")
    plain = snippets
    if crowded:
        many, _ = write_table(
            grams.where(F.col("n") > crowd).select(F.col("gram").alias("m_gram")), "grams"
        )
        same = F.col("gram") == F.col("m_gram")
        plain = snippets.join(many, same, "left_anti")
    again = (
        plain.repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_merge(length), "gram long, d1 long, d2 long, low long, high long")
    )
    if crowded:
        again = again.unionByName(
            _crowded_windows(snippets.join(many, same, "left_semi"), length)
        )
    again, _ = write_table(
        again.select(
            F.col("gram").alias("a_gram"), F.col("d1").alias("a_d1"), F.col("d2").alias("a_d2"), "low", "high"
        ),
        "windows",
    )
    windows = rows.join(
        again,
        (F.col("gram") == F.col("a_gram")) & (F.col("d1") == F.col("a_d1")) & (F.col("d2") == F.col("a_d2")),
    ).select("uid", (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high"))

    @F.arrow_udf("array<struct<low: long, high: long>>")
    def merged(found: pa.Array) -> pa.Array:
        spans = [
            [{"low": low, "high": high} for low, high in _merged_spans(
                [(w["low"], w["high"]) for w in own], length)]
            for own in found.to_pylist()
        ]
        return pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))

    # A list is one text's own windows, bounded by its length.
    lists = windows.groupBy("uid").agg(
        F.collect_list(F.struct("low", "high")).alias("found")
    )
    return lists.select("uid", merged("found").alias("spans"))


def without_repeats(
    df: DataFrame, id_column: str, text_column: str, length: int = LENGTH, crowd: int = CROWD
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    if length % LETTER or length <= GRAM:
        raise ValueError(f"length must be a multiple of {LETTER} above {GRAM}")
    rows, _ = write_table(
        df.select(
            F.monotonically_increasing_id().alias("uid"),
            col(id_column).alias("doc_id"),
            text_of(col(text_column)).alias("text"),
        ),
        "numbered",
    )
    spans, _ = write_table(
        spans_to_remove(rows.select("uid", "text"), length, crowd).withColumnRenamed("uid", "s_uid"),
        "spans",
    )
    return (
        rows.join(spans.hint("shuffle_merge"), F.col("uid") == F.col("s_uid"), "left")
        .select(
            "doc_id",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.arrow_udf(_kept, _KEPT)("text", "spans").alias("kept"),
        )
        .select("doc_id", "n_bytes", "kept.*")
    )
