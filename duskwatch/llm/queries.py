"""One query per operator, over its whole table, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm import (
    bpe,
    chat,
    extraction,
    hard_negatives,
    knn,
    language_id,
    mixing,
    pii,
    secrets,
    simhash,
    spotsigs,
    url_rules,
    variants,
)
from duskwatch.llm.common import table, with_results

DOMAINS = ("good", "poor", "toxic")
DOMAIN_WEIGHTS = {"good": 0.88, "poor": 0.12, "toxic": 0.0}


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) from quality and toxic flags; null where a flag that decides is null."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(
        F.col("toxic") == 0, F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    )
    return labels.select("doc_id", domain.alias("domain"))


def op1_simhash(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    found = simhash.near_duplicates(docs, simhash.EXACT)
    fingerprint = simhash.hexadecimal(F.col("print")[0])
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op2_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text", "lang")
    drawn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    docs = docs.withColumn("held_out", drawn)
    model = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.identify(docs, model, keep=["doc_id", "held_out"])


def op3_top_k(spark: SparkSession, directory: str) -> DataFrame:
    vectors = table(spark, directory, "embeddings").select("vec_id", "embedding")
    return knn.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def _digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of base spans of each kind, their hash, and all spans, from a spans column."""
    base = F.filter("spans", lambda s: s["exact"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in kinds],
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


def op4_secrets(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    found = docs.select("doc_id", secrets.detected(F.col("text")).alias("spans"))
    return _digests(found, secrets.KINDS[:3])


def op5_bpe(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    digests = bpe.token_digests(F.col("text"), public_tokenizers.path("word_bpe_49k.json"))
    return with_results(docs, digests, ["doc_id"], ["n_tokens", "ids_sha256", "decoded_sha256"])


def op6_mixing(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    labels = labelled_domains(table(spark, directory, "labels"))
    model = mixing.fit(docs, labels, DOMAINS)
    return mixing.mix(docs, model, DOMAIN_WEIGHTS, keep=["doc_id"], hold=1e-6)


# Host, path and verdict of each rule
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op7_urls(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages").select("page_id", "url")
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return url_rules.judge(pages, rules)


def op8_pii(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents")
    found = docs.select("doc_id", pii.detected(F.col("text"), pii.fit(docs)).alias("spans"))
    return _digests(found, pii.KINDS)


def op9_spotsigs(spark: SparkSession, directory: str) -> DataFrame:
    return spotsigs.edited_neighbours(table(spark, directory, "documents"))


# A conversation that quotes control strings of instruction templates
QUOTING = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op10_chat(spark: SparkSession, directory: str) -> DataFrame:
    schema = "conv_id long, turn long, role string, text string"
    rows = table(spark, directory, "conversations").select("conv_id", "turn", "role", "text")
    template = chat.INSTRUCTIONS
    chats = chat.format_chats(rows.union(spark.createDataFrame(QUOTING, schema)), template)
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"])
    loss = chat.unescaped(F.array_join(learned, ""), template)
    return chats.withColumn("turns", chat.read_back(F.col("formatted"), template)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op11_variants(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return variants.forms(variants.word_counts(docs, damage=199))


def op12_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    vectors = table(spark, directory, "embeddings").select("vec_id", "embedding", "label")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("id") % 50 == 0, label=wrong)


def op13_main_text(spark: SparkSession, directory: str) -> DataFrame:
    pages = table(spark, directory, "pages").select("page_id", "url", "html")
    text = extraction.main_text(F.col("html"), extraction.fit(pages))
    told = pages.select("page_id", "url", text.alias("text"))
    return told.withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_language": op2_language,
    "op3_top_k": op3_top_k,
    "op4_secrets": op4_secrets,
    "op5_bpe": op5_bpe,
    "op6_mixing": op6_mixing,
    "op7_urls": op7_urls,
    "op8_pii": op8_pii,
    "op9_spotsigs": op9_spotsigs,
    "op10_chat": op10_chat,
    "op11_variants": op11_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_main_text": op13_main_text,
}

_ORACLE_3 = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
    FROM usable q JOIN usable d ON q.vec_id != d.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""

_ORACLE_7 = """
WITH address AS (
    SELECT page_id,
           CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1)
                ELSE '' END AS path
    FROM pages
), rules(rule_host, rule_path, verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM address) AS a JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM address LEFT JOIN best USING (host, path)
"""

_ORACLE_12 = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id != b.vec_id
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id, score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""


def _escaped_in_sql(column: str) -> str:
    escape, out = chat.INSTRUCTIONS.escape, column
    for i, control in enumerate([escape, *chat.INSTRUCTIONS.controls]):
        out = f"replace({out}, '{control}', '{escape}{chr(65 + i)}')"
    return out


_ORACLE_10 = f"""
WITH every AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
    SELECT *, length({_escaped_in_sql('text')}) + CASE role
        WHEN 'system' THEN length('<<SYS>><</SYS>>') WHEN 'user' THEN length('[INST][/INST]')
        WHEN 'assistant' THEN length('<s></s>')
        ELSE length('[ROLE][SAYS][/SAYS]') + length({_escaped_in_sql('role')}) END AS chars
    FROM every
), joined AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
           string_agg(role, '>' ORDER BY turn NULLS FIRST, role, text) AS roles,
           coalesce(string_agg(CASE role WHEN 'assistant' THEN text END, ''
                    ORDER BY turn NULLS FIRST, role, text), '') AS loss
    FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
       regexp_full_match(roles, '(system>)?user>assistant(>user>assistant)*') AS valid
FROM joined
"""

ORACLES: dict[str, str] = {
    "op3_top_k": _ORACLE_3,
    "op7_urls": _ORACLE_7,
    "op10_chat": _ORACLE_10,
    "op12_hard_negatives": _ORACLE_12,
}
