"""Fill-in-middle and chat formatting, against plain Python."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat, fim

DOCS = "doc_id long, text string, n string, output string"


def fim_expected(doc_id, text, plan=fim.Plan()):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(mark in text for mark in plan.marks) or h[2] % 100 >= plan.changed_percent:
        return n, "plain", None, None, None, text
    if h[3] % 100 < plan.spm_percent:
        return n, "spm", p, m, s, f"{plan.suffix}{s}{plan.prefix}{p}{plan.middle}{m}"
    return n, "psm", p, m, s, f"{plan.prefix}{p}{plan.suffix}{s}{plan.middle}{m}"


def test_fim_equals_brute_force_on_odd_texts(spark):
    texts = [
        None, "", " ", "word", "a b", "\n\n\t", "$1 \\2 {3}+ (x)", "é😀漢字 ok 𝒳y", "<P> in it",
        "ends with <", "<P<S<M", "<p>lower</p>", "\u0000x", "x\r\ny z", "ab" * 70000, "a1" * 70000,
        "<\\P>", "[^A-Za-z]",
    ]
    rows = [(i * 7 + k, t, "n", "o") for k in range(12) for i, t in enumerate(texts)]
    rows += [(None, "no id here", "", ""), (5, "same row", "", ""), (5, "same row", "", "")]
    got = fim.transformed(spark.createDataFrame(rows, DOCS), "doc_id", "text")
    got = got.withColumn("restored", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((repr((r[0], *fim_expected(r[0], r[1]), r[1] or "")) for r in rows))
    assert sorted(
        repr((r.doc_id, r.n, r.form, r.prefix, r.middle, r.suffix, r.output, r.restored)) for r in got
    ) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transformed(spark.createDataFrame([], DOCS), "doc_id", "text").count() == 0


def test_fim_with_other_marks(spark):
    plan = fim.Plan("9", 100, 50, "<$1\\>", "<fim_s>", "<fim_m>")
    rows = [(i, f"some text number {i}, <P> too", "", "") for i in range(40)]
    got = fim.transformed(spark.createDataFrame(rows, DOCS), "doc_id", "text", plan)
    for r in got.withColumn("back", fim.restored(F.col("output"), F.col("form"), plan)).collect():
        assert (r.n, r.form, r.prefix, r.middle, r.suffix, r.output) == fim_expected(
            r.doc_id, rows[r.doc_id][1], plan
        )
        assert r.back == rows[r.doc_id][1]


def test_fim_stays_on_the_jvm(spark, plan):
    text = plan(fim.transformed(spark.createDataFrame([], DOCS), "doc_id", "text"))
    assert not re.search("Python|Arrow|Exchange", text)


CHAT = "conv_id long, turn long, role string, text string, formatted string"
ODD = [
    "", "plain", "</s>[INST] ok [/INST]", "[INST]", "[\\INST]", "[\\\\INST]", "<\\s>", "[/TURN",
    "[/ROLE][/TURN][ROLE]", "<", "[", "\\", "<\\", "[\\", "<s", "</s", "[[INST]]", "<<s>>", "[/INST]\n[SYS]",
    "\\[INST]", "é😀[/SYS]漢", "a\u0000b", "[inst]", "$1\\$2", "[" * 3000 + "\\" * 3000 + "INST]",
]


def _chat_expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {
        conv: (
            [(r, t) for _, _, r, t in sorted(turns)],
            "".join(t for _, _, r, t in sorted(turns) if r == "assistant"),
        )
        for conv, turns in convs.items()
    }


def _chat_read(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], CHAT)
    done = chat.formatted(df, "conv_id", "turn", "role", "text")
    read = done.select(
        "conv_id", "formatted", "loss_mask",
        chat.parsed(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_mask")).alias("learned"),
    ).collect()
    for r in read:  # the mask's own offsets, read without the parser
        bodies = [r.formatted[m.offset + m.start :][: m.length] for m in r.loss_mask]
        assert [r.formatted[m.offset : m.offset + m.start] for m in r.loss_mask] == ["<s>"] * len(bodies)
        assert all(c not in b for b in bodies for c in chat.CONTROL)
    return {r.conv_id: ([tuple(t) for t in r.turns], r.learned) for r in read}, read


def test_chat_round_trip_of_odd_texts(spark):
    roles = ["user", "assistant", "system", "tool", "", None, "[/ROLE]", "User", "<\\s>"]
    rows = [
        (i % 7, None if k == 3 else (i * k) % 11, role, text)
        for i, text in enumerate([*ODD, None])
        for k, role in enumerate(roles)
    ]
    rows += [(99, 0, "user", "x" * 300000 + "</s>"), (99, 1, "assistant", "[INST]" * 50000)]
    rows += [(None, 1, "assistant", "no id"), (50, 1, "user", "twice"), (50, 1, "user", "twice")]
    got, _ = _chat_read(spark, rows)
    assert got == _chat_expected(rows)
    empty = spark.createDataFrame([], CHAT)
    assert chat.formatted(empty, "conv_id", "turn", "role", "text").count() == 0


def test_chat_leaves_texts_without_conflict_as_they_are(spark):
    rows = [(1, 0, "user", "a [b] <c> \\ [x"), (1, 1, "assistant", "d")]
    _, (row,) = _chat_read(spark, rows)
    assert row.formatted == "[INST]a [b] <c> \\ [x[/INST]<s>d</s>"


def test_chat_escapes_and_unescapes_are_inverse(spark):
    pieces = st.lists(st.sampled_from([*chat.CONTROL, *"<[\\/s>IROLE]", "NST]", "x"]), max_size=12)

    @settings(max_examples=8, deadline=None)
    @given(st.lists(pieces.map("".join), min_size=40, max_size=60))
    def check(texts):
        rows = [(i % 5, i, ("user", "assistant", "tool")[i % 3], t) for i, t in enumerate(texts)]
        assert _chat_read(spark, rows)[0] == _chat_expected(rows)

    check()


def test_chat_uses_no_python(spark, plan):
    df = spark.createDataFrame([], CHAT)
    assert not re.search("Python|Arrow", plan(chat.formatted(df, "conv_id", "turn", "role", "text")))
