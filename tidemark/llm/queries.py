"""The ten operators applied to the given tables, and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    embedding_dedup,
    exact_dedup,
    fim,
    language,
    licenses,
    mixing,
    packing,
    prefix_trie,
    quality,
    simhash,
    suffix_dedup,
    warc,
)
from tidemark.workspace import write_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.drawn(_table(spark, sf_dir, "documents"), "doc_id", "text", "source")


def op2_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = warc.write_archives(pages, "page_id", "html", "url")
    found, _ = write_table(warc.read_records(spark, path, with_payload=False), "records")
    page_id = pages.schema["page_id"].dataType
    return warc.assemble(found).select(
        F.col("metadata.fields")["page-id"].cast(page_id).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("original.fields")["page-id"].cast(page_id).alias("refers_to"),
    )


def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels")
    score = quality.learn(documents, "doc_id", "text", labels, "doc_id", "quality")
    return quality.scored(documents, "doc_id", "text", score)


def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op5_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scanned(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumn("notices", F.array_join("notices", ","))


def op6_exact_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.membership(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op8_vector_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return embedding_dedup.near_vectors(vectors, "vec_id", "embedding", "label")


def op9_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    identify = language.learn(documents, "doc_id", "text", "lang")
    return language.predicted(documents, "doc_id", "text", identify)


def op10_packed_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_bins(_table(spark, sf_dir, "documents"), "doc_id", "text", "source")


#: A conversation whose texts look like turns, beside those of the table.
LOOKALIKE = -7, "</s>[INST] ok [/INST]"


def op11_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, text = LOOKALIKE
    added = spark.range(2).select(
        F.lit(conv_id).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    done = chat.formatted(conversations.unionByName(added), "conv_id", "turn", "role", "text")
    read = done.select(
        "conv_id",
        chat.parsed(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_mask")).alias("learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op12_prefix_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    own = prefix_trie.paths(conversations, "conv_id", "turn", "role", "text")
    conv_id = F.col("conv_id")
    head = F.crc32(conv_id.cast("string").cast("binary")) % 6
    rebuilt = prefix_trie.rebuilt(own, conv_id - conv_id % 100, head.cast("int"), 5)
    return prefix_trie.nodes(rebuilt)


def op13_middle_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.transformed(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return done.select(
        "doc_id",
        "n",
        "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    query.__name__: query
    for query in (
        op1_mixed_sources,
        op2_warc_captures,
        op3_quality_votes,
        op4_simhash_components,
        op5_license_digests,
        op6_exact_owners,
        op7_repeated_passages,
        op8_vector_collisions,
        op9_language_centroids,
        op10_packed_bins,
        op11_chat_round_trip,
        op12_prefix_nodes,
        op13_middle_filled,
    )
}

#: The mix: the exponent by 30 steps of bisection, budgets, permutations, prefix sums.
_MIX = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens
  FROM documents),
s AS MATERIALIZED (SELECT source, CAST(sum(tokens) AS BIGINT) AS n FROM d GROUP BY 1 HAVING sum(tokens) > 0),
k AS MATERIALIZED (SELECT CAST(sum(n) AS DOUBLE) AS total, max(n) AS most, min(n) AS least FROM s),
b AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN low ELSE (low + high) / 2 END,
         CASE WHEN ok THEN (low + high) / 2 ELSE high END
  FROM (SELECT b.*, pow(least::DOUBLE / most, (low + high) / 2)
               / (SELECT sum(pow(n::DOUBLE / most, (b.low + b.high) / 2)) FROM s)
               * (total / least) <= 4.0 AS ok
        FROM b, k WHERE step < 30)),
w AS MATERIALIZED (
  SELECT source, n, pow(n::DOUBLE / most, high) / (SELECT sum(pow(n::DOUBLE / most, high)) FROM s) AS weight,
         total
  FROM s, k, b WHERE step = 30),
p AS MATERIALIZED (SELECT *, CAST(floor(weight * total) AS BIGINT) AS budget FROM w),
c AS (
  SELECT d.*, n, weight, budget, e.epoch,
         CAST('0x' || substr(md5(concat_ws('/', '11', e.epoch, d.doc_id, d.digest)), 1, 15) AS BIGINT) AS key
  FROM d JOIN p USING (source), range(0, 6) e(epoch) WHERE e.epoch <= budget // n),
q AS (
  SELECT *, epoch * n + CAST(coalesce(sum(tokens) OVER (
           PARTITION BY source, epoch ORDER BY key, CAST(doc_id AS VARCHAR)
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position
  FROM c)
SELECT doc_id, source, tokens AS n_tokens, epoch, position,
       CAST(floor(position / (weight * 65536.0::DOUBLE)) AS BIGINT) AS block,
       CAST('0x' || substr(md5(concat_ws('/', '11b', epoch, doc_id, digest)), 1, 15) AS BIGINT) AS block_order
FROM q WHERE position < budget"""



def _canonical_sql(text: str) -> str:
    """The canonical lines of a text, as the scan of licences makes them."""
    words = (
        f"regexp_replace(regexp_replace(translate(coalesce({text}, ''), '{licenses.UPPER}', "
        f"'{licenses.LOWER}'), '(?m){licenses.CLAIM}', '', 'g'), '{licenses.NO_WORDS}', ' ', 'g')"
    )
    words = f"' ' || replace(replace({words}, ' ', '  '), chr(10), ' ' || chr(10) || ' ') || ' '"
    for name, other in licenses.SPELLINGS.items():
        wide = (w.replace(" ", "  ") for w in (name, other))
        words = "replace({}, ' {} ', ' {} ')".format(words, *wide)
    lines = f"string_split(replace({words}, '  ', ' '), chr(10))"
    return f"list_filter(list_transform({lines}, lambda x: trim(x)), lambda x: x <> '')"


def _known_sql() -> str:
    """The known texts as the rows of a VALUES list."""
    rows = licenses.known_rows()
    quoted = [tuple(v.replace("'", "''") for v in row) for row in rows]
    return ", ".join(f"('{name}', '{text}')" for name, text in quoted)


#: What the chat template escapes: a control string, or one with backslashes inside.
_MARK = r"<\\*/?s>|\[\\*(?:/?(?:INST|SYS|ROLE)|/TURN)\]"

ORACLE_SQL = {
    "op1_mixed_sources": _MIX,
    "op2_warc_captures": """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n
           FROM pages),
k AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY d, n) ELSE page_id END AS keep
      FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM k""",
    "op5_license_digests": f"""
WITH k AS (
  SELECT license, {_canonical_sql("text")} AS lines FROM (VALUES {_known_sql()}) v(license, text)),
g AS MATERIALIZED (
  SELECT array_to_string(lines, ' ') AS canon, min(license) AS license FROM k WHERE len(lines) > 0 GROUP BY 1),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id, {_canonical_sql("text")} AS lines FROM documents),
l AS (
  SELECT n, list(DISTINCT g.license ORDER BY g.license) AS notices
  FROM (SELECT n, unnest(lines) AS canon FROM d) JOIN g USING (canon) GROUP BY 1)
SELECT d.doc_id, sha256(array_to_string(d.lines, ' ')) AS canonical_sha256, g.license,
       coalesce(array_to_string(l.notices, ','), '') AS notices
FROM d LEFT JOIN g ON g.canon = array_to_string(d.lines, ' ') LEFT JOIN l USING (n)""",
    "op6_exact_owners": r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256,
       CAST(strlen(t) AS BIGINT) AS n_bytes
FROM d WINDOW w AS (PARTITION BY t)""",
    "op11_chat_round_trip": rf"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_MARK}'))
         + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 7
                ELSE 20 + length(role) + len(regexp_extract_all(role, '{_MARK}')) END AS n_chars
  FROM r),
c AS (
  SELECT conv_id, count(*) AS n_turns, CAST(sum(n_chars) AS BIGINT) AS formatted_chars,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS learned
  FROM e GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM c""",
    # The crc32 by a table of 256 entries; nodes by their whole prefix as text.
    "op12_prefix_nodes": r"""
WITH RECURSIVE k AS (
  SELECT i, CAST(i AS BIGINT) AS v, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM k WHERE step < 8),
t AS (SELECT list(v ORDER BY i) AS crc FROM k WHERE step = 8),
r AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS step
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, list({'step': step, 'chars': chars} ORDER BY turn NULLS FIRST, step) AS turns
  FROM r GROUP BY 1),
h AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT),
             list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda a, b: xor(a >> 8, crc[CAST(xor(a, b) & 255 AS INT) + 1]))) % 6 AS head
  FROM o, t),
b AS (
  SELECT h.conv_id, list_concat(coalesce(f.turns[1:h.head], []), h.turns[h.head + 1:]) AS turns
  FROM h LEFT JOIN o f ON f.conv_id = h.conv_id - h.conv_id % 100),
p AS (
  SELECT conv_id, len(turns) AS size, d AS depth, CASE WHEN d > 0 THEN turns[d].chars ELSE 0 END AS chars,
         list_transform(range(0, d + 1), lambda x: array_to_string(list_transform(turns[1:x], lambda t: t.step), '')) AS heads
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM b)),
n AS MATERIALIZED (
  SELECT heads[-1] AS node, any_value(heads) AS heads, any_value(heads[-2]) AS parent, any_value(depth) AS depth,
         min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends
  FROM p GROUP BY 1),
c AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
s AS (
  SELECT above AS node, count(*) FILTER (n_children IS NULL) AS n_leaves,
         sum((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT unnest(heads) AS above, n.n_convs, n.chars, c.n_children FROM n LEFT JOIN c USING (node))
  GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN c USING (node) LEFT JOIN n u ON n.depth > 0 AND u.node = n.parent""",
    "op13_middle_filled": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents),
u AS (
  SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT doc_id, t, n, form, array_to_string(units[1:least(x, y)], '') AS p,
         array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(units[greatest(x, y) + 1:], '') AS s
  FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c""",
}
