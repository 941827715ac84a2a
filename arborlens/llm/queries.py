"""One query for each operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlens.llm import bpe, chat, filter_audit, langid, licences, merkle, mixing, ngram_join, pii, quality, simhash, token_files, toxicity
from arborlens.llm.common import cut, shared_folder, table

#: Labelled rows that a classifier is fitted on, at most.
MAX_LABELLED = 4000
#: Bytes of training text of each language, at most.
MAX_LANGUAGE_BYTES = 200_000
#: The tokenizer file; a path that every executor can read.
VOCABULARY_VARIABLE, VOCABULARY = "ARBORLENS_VOCABULARY", "word_bpe_49k.json"


def vocabulary() -> str:
    named = os.environ.get(VOCABULARY_VARIABLE)
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.OrdinalModel:
    """The labels only say toxic or not, so the toxic ones are graded by toxicity.severity."""
    return toxicity.fit(toxicity.sample(docs, labels, F.when(F.col("toxic") > 0, 1).when(F.col("toxic").isNotNull(), 0), MAX_LABELLED), yes_no=True)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).drop("text")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(simhash.sensitivity(table(spark, sf_dir, "documents")))
    within = simhash.count_within(rows, "fp", F.col("doc_id") % 20 == 0, radius=3, extra=simhash.whole_blocks(rows.count()))
    counted = rows.join(within, "fp", "left")
    return counted.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.as_hex(F.col("fp")).alias("fingerprint"),
        simhash.as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
        simhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        simhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % 20 == 0, F.col("n_within")).alias("n_within_3_bits"),
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    tables = langid.PpmTables.train(langid.training_texts(docs, ~held_out, MAX_LANGUAGE_BYTES))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), tables).drop("text")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.digest(chat.format_conversations(turns.unionByName(probe)))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, keep_keys=True)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = cut(quality.with_statistics(docs.select("doc_id", "text")).drop("text"))  # narrow; texts are read once
    return quality.judged(stats, quality.fit_statistics(stats, table(spark, sf_dir, "labels")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.spans_text(F.col("base_spans")), 256).alias("base_sha256"), pii.spans_text(F.col("pii_spans")).alias("spans"))


def op11_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "records")
    token_files.write(table(spark, sf_dir, "documents"), folder, vocabulary(), end_id=2)
    return token_files.read(spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.verify(table(spark, sf_dir, "documents"), {"text": text})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_licences": op2_licences,
    "op3_ngram_join": op3_ngram_join,
    "op4_simhash": op4_simhash,
    "op5_language": op5_language,
    "op6_chat": op6_chat,
    "op7_bpe": op7_bpe,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_records": op11_records,
    "op12_filter_audit": op12_filter_audit,
    "op13_merkle": op13_merkle,
}

# brute force over all pairs, which is fine on the small tables; words are split and lower-cased as in the operator
_NGRAM_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w
), d AS (SELECT s, min(doc_id) AS sid FROM (SELECT doc_id, list_sort(s) AS s FROM s WHERE len(s) > 0) GROUP BY s),
t AS (SELECT sid, len(s) AS n, unnest(s) AS t FROM d),
o AS (SELECT a.sid AS a, b.sid AS b, a.n AS na, b.n AS nb, count(*) AS k FROM t a JOIN t b ON a.t = b.t AND a.sid <> b.sid GROUP BY ALL),
e AS (SELECT a, b FROM o WHERE 100 * k >= 75 * (na + nb - k)),
r(x, y) AS (SELECT sid, sid FROM d UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a),
c AS (SELECT x AS sid, min(y) AS comp FROM r GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(c.comp, s.doc_id) AS component_id
FROM s LEFT JOIN d ON list_sort(s.s) = d.s LEFT JOIN c ON c.sid = d.sid"""

_ESCAPED = "replace(replace(replace(replace(replace(replace({c}, '~', '~0'), '</s>', '~1'), '<s>', '~2'), '[INST]', '~3'), '[/INST]', '~4'), '[SEP]', '~5')"

# list_reduce over bytes, eight turns of the remainder for each
_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({c}, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: xor(a >> 1, (a & 1) * 3988292384))), 4294967295)"""
_FIELD = "coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD if c == "text" else _FIELD.format(c=c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
_PARENTS = "list_transform(range(0, (len(nodes) + 2) // 3), lambda k: sha256(array_to_string(nodes[3 * k + 1:3 * k + 3], '')))"
_AROUND = "array_to_string(nodes[i // 3 * 3 + 1:i], '') AS l, array_to_string(nodes[i + 2:i // 3 * 3 + 3], '') AS r"

ORACLE_SQL: dict[str, str] = {
    "op3_ngram_join": _NGRAM_SQL,
    "op6_chat": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
  SELECT *, coalesce(lag(role) OVER w <> role, TRUE) AS new FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESCAPED.format(c='text')}) + CASE WHEN new THEN 22 + length({_ESCAPED.format(c='role')}) ELSE 5 END)::BIGINT AS formatted_chars
FROM r GROUP BY conv_id""",
    "op8_mixing": """
WITH s AS (
  SELECT source, sum(coalesce(length(text), 0)) AS c FROM documents GROUP BY source
), m AS (
  SELECT source, CASE WHEN c = 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE / (SELECT count(*) FROM s) * (SELECT sum(c) FROM s)::DOUBLE / c END AS mean FROM s
), p AS (
  SELECT source, k, exp(k * ln(mean) - mean - lgamma(k + 1)) AS p
  FROM m, LATERAL (SELECT unnest(range(0, 2 + ceil(mean + 12 * sqrt(mean) + 24)::BIGINT)) AS k)
), c AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM p
), d AS (
  SELECT doc_id, source, text, ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / pow(2, 52) AS u FROM documents
), n AS (
  SELECT d.doc_id, d.source, d.text, count(*) AS copies
  FROM (SELECT *, row_number() OVER () AS r FROM d) d JOIN c ON d.source IS NOT DISTINCT FROM c.source AND c.cdf <= d.u
  GROUP BY r, d.doc_id, d.source, d.text
)
SELECT doc_id, source, text, copy::BIGINT AS copy, md5('17/order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key
FROM n, LATERAL (SELECT unnest(range(0, copies)) AS copy)""",
    "op12_filter_audit": """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), FALSE) AS e FROM documents
), f AS (
  SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS f FROM d
), n AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM f LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id) GROUP BY part, f
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS o FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
), s AS (
  SELECT part, o, f, n, good, toxic, CASE WHEN contains(f, o[1]) THEN 1 WHEN contains(f, o[2]) THEN 2 WHEN contains(f, o[3]) THEN 3 WHEN contains(f, o[4]) THEN 4 WHEN contains(f, o[5]) THEN 5 ELSE 6 END AS first FROM n, o
), r AS (
  SELECT part, o, step, o[step] AS filter, sum(n) FILTER (WHERE first > step) AS kept, sum(n) FILTER (WHERE first = step) AS removed,
    sum(n) FILTER (WHERE first < step AND contains(f, o[step])) AS redundant, sum(n) FILTER (WHERE f = o[step]) AS unique_fails,
    sum(good) FILTER (WHERE first = step) AS good_lost, sum(toxic) FILTER (WHERE first = step) AS toxic_lost
  FROM s, (SELECT unnest([1, 2, 3, 4, 5]) AS step) GROUP BY part, o, step
)
SELECT part, o AS filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley FROM r""",
    "op13_merkle": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_LEAF.format(c="text")} AS leaf,
    {_LEAF.format(c=f"(CASE WHEN {_CRC32.format(c='doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS now FROM documents
), n AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1)::BIGINT AS i FROM d
), t(source, lvl, nodes) AS (
  SELECT source, 0, list(leaf ORDER BY i) FROM n GROUP BY source
  UNION ALL SELECT source, lvl + 1, {_PARENTS} FROM t WHERE len(nodes) > 1
), s AS (
  SELECT source, nodes[1] AS subroot, (row_number() OVER (ORDER BY source NULLS FIRST) - 1)::BIGINT AS i FROM t WHERE len(nodes) = 1
), u(lvl, nodes) AS (
  SELECT 0, list(subroot ORDER BY i) FROM s
  UNION ALL SELECT lvl + 1, {_PARENTS} FROM u WHERE len(nodes) > 1
), p AS (
  SELECT source, leaf0, lvl, {_AROUND} FROM (SELECT n.source, n.i AS leaf0, lvl, nodes, n.i // pow(3, lvl)::BIGINT AS i FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source WHERE len(nodes) > 1)
), q AS (
  SELECT source, lvl + 1000 AS lvl, {_AROUND} FROM (SELECT s.source, lvl, nodes, s.i // pow(3, lvl)::BIGINT AS i FROM s, u WHERE len(nodes) > 1)
), a AS (
  SELECT source, leaf0, lvl, l, r FROM p UNION ALL SELECT n.source, n.i, lvl, l, r FROM n JOIN q ON n.source IS NOT DISTINCT FROM q.source
), g AS (
  SELECT source, leaf0, string_agg(l || r, '' ORDER BY lvl) AS proof, list({{'l': l, 'r': r}} ORDER BY lvl) AS path FROM a GROUP BY source, leaf0
), z AS (
  SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend({{'l': now, 'r': ''}}, coalesce(path, [])), lambda b, x: {{'l': sha256(x.l || b.l || x.r), 'r': ''}}).l AS folded_root
  FROM n JOIN s ON n.source IS NOT DISTINCT FROM s.source LEFT JOIN g ON n.source IS NOT DISTINCT FROM g.source AND n.i = g.leaf0
)
SELECT *, folded_root = root AS verified FROM z""",
}
