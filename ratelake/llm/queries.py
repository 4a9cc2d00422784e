"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelake.llm import conversation_repair, decontaminate, exact_dedup, html_wrapper, jaccard_join, language_id, minhash_dedup, mixing, periodic_runs, quality, repeated_windows, token_files, toxicity
from ratelake.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


#: Target token shares of the domains that ``domain_labels`` names.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def domain_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the rows in the labels table: their language is the domain."""
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id"), "doc_id", "left_semi")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.document_rates(docs, domain_labels(docs, table(spark, sf_dir, "labels")), TARGETS)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_windows.without_repeats(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.main_texts(table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.languages(docs, language_id.train(docs))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_index(table(spark, sf_dir, "documents"), token_files.default_tokenizer())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    found = [
        op1_mixing, op2_jaccard_join, op3_toxicity, op4_repeated_windows, op5_main_text, op6_language_id, op7_decontaminate,
        op8_exact_dedup, op9_token_files, op10_quality, op11_conversation_repair, op12_minhash_dedup, op13_periodic_runs,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jaccard_join": JACCARD_JOIN,
        "op4_repeated_windows": REPEATED_WINDOWS,
        "op8_exact_dedup": EXACT_DEDUP,
        "op11_conversation_repair": CONVERSATION_REPAIR,
        "op12_minhash_dedup": MINHASH_DEDUP,
        "op13_periodic_runs": PERIODIC_RUNS,
    }


EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), g AS (
  SELECT content, count(*) AS group_size, arg_max(doc_id, len::HUGEINT * 10000000000000000000 - doc_id) AS keep_id
  FROM n GROUP BY content
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.content) AS text_sha256
FROM n JOIN g USING (content)
"""

JACCARD_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 75 * (nx.size + ny.size - c)
), reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.doc_id WHERE r.root < l.y
)
SELECT r.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(r.root) AS component_id
FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""

REPEATED_WINDOWS = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), k AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
), f AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS least FROM k) WHERE least < doc_id
), c AS (SELECT DISTINCT doc_id, i + o AS j FROM f, (SELECT unnest(range(13)) AS o)),
e AS (SELECT doc_id, generate_subscripts(words, 1) AS j, unnest(words) AS word FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS text, count(*) AS n FROM e ANTI JOIN c USING (doc_id, j) GROUP BY doc_id
)
SELECT w.doc_id, len(words) AS n_words, len(words) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

#: crc32 of ASCII text in SQL: its byte table by the rule of the polynomial, then one step a character.
CRC_TABLE = """
SELECT list(list_reduce([x] || range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY x) AS crc_table
FROM (SELECT unnest(range(256)) AS x)
"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an SQL expression; ``crc_table`` must be in scope."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(4294967295, list_reduce([4294967295] || {codes}, lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"


PERIODIC_RUNS = rf"""
WITH t AS ({CRC_TABLE}), h AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, {crc32_sql("doc_id::VARCHAR")} AS h
  FROM documents, t
), a AS (
  SELECT *, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM h
), p AS (
  SELECT *, 1 + (len(words) - a) // (3 + (h // 10) % 8) AS p FROM a
), w AS (
  SELECT doc_id, CASE WHEN a IS NULL THEN words
    ELSE words[1:a] || list_transform(range(len(words) - a), lambda i: words[a + 1 + i % p]) END AS words
  FROM p
), six AS (
  SELECT doc_id, i, array_to_string(words[i + 1:i + 6], ' ') AS win FROM (SELECT doc_id, words, unnest(range(len(words) - 5)) AS i FROM w WHERE len(words) >= 12)
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS period FROM six x JOIN six y ON x.doc_id = y.doc_id AND x.win = y.win AND x.i < y.i
), stretches AS (
  SELECT doc_id, period, min(i) AS start, count(*) + 5 + period AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM pairs) GROUP BY doc_id, period, island
), runs AS (
  SELECT doc_id, start, length, min(period) AS period FROM stretches WHERE length >= greatest(12, 2 * period) GROUP BY doc_id, start, length
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    first(struct_pack(start, length, period) ORDER BY length DESC, start, period) AS best
  FROM runs GROUP BY doc_id
), dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT doc_id, unnest(range(len(words))) AS i, unnest(words) AS word FROM w) ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM w LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _edit(value: str, cost: str, edit: str) -> str:
    """SQL for a value (nine digits of cost, then the audit) with one more edit in front."""
    return f"(lpad((left({value}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || '{edit}' || substr({value}, 10))"


def _before_row(state: str, ahead: str, keeps: str) -> str:
    """SQL for the least value before row ``r`` from ``state``; ``keeps`` maps kept initials to the state behind."""
    kept = " ".join(f"WHEN '{c}' THEN {_edit(f'd.{to}', 'r.short', 'K')}" for c, to in keeps)
    usable = f"CASE WHEN NOT r.gone THEN least({_edit(f'd.{ahead}', '2 + r.short', 'R')}, CASE r.initial {kept} END) END"
    return f"least({_edit(f'd.{state}', '3', 'D')}, {usable}) AS {state}"


# Backward over rows; values compare by cost, then audit.  v0, vs, vu, va: what was said last is nothing, system, user, assistant.
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE t AS ({CRC_TABLE}), k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations, t
), x AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_replace(text, '[ 	-
]+$', '') AS trimmed FROM x
), f AS (
  SELECT *, left(role, 1) AS initial, trimmed = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM n
), r AS (
  SELECT *, blank OR again AS gone, CASE WHEN right(trimmed, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS short FROM f
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank)::BIGINT AS blank, count_if(again AND NOT blank)::BIGINT AS duplicate,
    count_if(NOT gone AND short = 1)::BIGINT AS truncated, count_if(pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, count(*) AS n
  FROM r GROUP BY conv_id
), d AS (
  SELECT conv_id, n + 1 AS i, '000000000' AS v0, '000000004II' AS vs, '000000002I' AS vu, '000000000' AS va FROM facts
  UNION ALL
  SELECT conv_id, i, least(v0, {_edit("vu", "2", "I")}, {_edit("va", "4", "II")}), least(vs, {_edit("vu", "2", "I")}, {_edit("va", "4", "II")}),
    least(vu, {_edit("va", "2", "I")}), least(va, {_edit("vu", "2", "I")})
  FROM (
    SELECT d.conv_id, r.i, {_before_row("v0", "vu", [("s", "vs"), ("u", "vu")])}, {_before_row("vs", "vu", [("u", "vu")])},
      {_before_row("vu", "va", [("a", "va")])}, {_before_row("va", "vu", [("u", "vu")])}
    FROM d JOIN r ON r.conv_id = d.conv_id AND r.i = d.i - 1
  )
), best AS (
  SELECT conv_id, left(v0, 9)::BIGINT AS cost, substr(v0, 10) AS audit FROM d WHERE i = 1
), e AS (
  SELECT conv_id, edit, seq, count_if(edit <> 'I') OVER w AS i, count_if(edit <> 'D') OVER w AS place
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS seq FROM best WHERE audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY seq)
), said AS (
  SELECT e.*, r.role, r.text, max((edit = 'K' AND place = 1 AND left(r.role, 1) = 's')::INT) OVER (PARTITION BY e.conv_id) AS system
  FROM e LEFT JOIN r ON r.conv_id = e.conv_id AND r.i = e.i AND e.edit <> 'I' WHERE edit <> 'D'
), lines AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY seq) AS repaired
  FROM said GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN lines USING (conv_id)
"""

MINHASH_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 1], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words), 2))) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
sized AS (SELECT s.*, size FROM s JOIN n USING (doc_id)),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.size) + any_value(b.size) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.doc_id WHERE r.root < l.y
)
SELECT r.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(r.root) AS component_id, r.doc_id = min(r.root) AS kept
FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""
