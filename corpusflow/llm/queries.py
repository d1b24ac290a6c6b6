"""The checked queries of the operators here: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, collocations, decontaminate, exact_dedup, jaccard, packing, repair, repetition, secrets, suffix_dedup, tokencount, warc
from .common import read
from ..operators.scale import written


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(
        read(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(repetition.measure(read(spark, sf_dir, "documents", "doc_id", "text")))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents", "doc_id", "text"), digest=True)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{name}") for kind, (name, _, _) in enumerate(secrets.BASE)],
        F.sha2(secrets.described(F.col("base")), 256).alias("base_sha256"),
        secrets.described(F.col("spans")).alias("spans"),
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats, expands, and reads turns and trained texts back from what was written."""
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT -1L AS conv_id, turn, role, '{marks}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    formatted = written(chat.format_conversations(turns.unionByName(extra)))
    examples = written(chat.expand(formatted))
    replies = F.array_sort(F.collect_list(F.struct("loss_start", chat.unescape(F.col("target")).alias("text"))))
    loss = examples.groupBy("conv_id").agg(F.array_join(F.transform(replies, lambda r: r["text"]), "").alias("loss"))
    back = F.transform(chat.parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    rows = formatted.select("conv_id", "formatted", back.alias("turns"))
    # a conversation without id is one, too
    loss = loss.withColumnRenamed("conv_id", "_conv")
    rows = rows.join(loss, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn("loss", F.coalesce("loss", F.lit("")))
    return rows.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_index(read(spark, sf_dir, "pages", "page_id", "url", "html"), min_revisit_bytes=0)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.report(repair.damage(turns), turns)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = decontaminate.matches(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents", "text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_chat_format": op6_chat_format,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_warc": op8_warc,
    "op9_pack": op9_pack,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_decontaminate": op12_decontaminate,
    "op13_collocations": op13_collocations,
}

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
_ESCAPED = "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), '|', '&#124;')"
_HEX = "CAST('0x' || substr(sha1(coalesce(html, '')), {0}, 5) AS BIGINT)"
_BASE32 = " || ".join(
    f"substr('{warc.BASE32}', CAST(({_HEX.format(5 * group + 1)} >> {shift}) & 31 AS BIGINT) + 1, 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op4_exact_dedup": f"""WITH normal AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents),
groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM normal JOIN groups USING (text_sha256)""",
    "op6_chat_format": f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
  SELECT -1, turn, role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)),
joined AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS all_text,
  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
  CAST(sum(11 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars FROM joined""",
    "op8_warc": f"""WITH payloads AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first_page FROM payloads GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_page THEN first_page END AS refers_to
FROM payloads JOIN firsts USING (payload_digest)""",
    "op12_decontaminate": f"""WITH items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, list_slice(w, i, i + least(len(w), 10) - 1) AS win FROM (
  SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS size FROM windows),
docs AS (SELECT row_number() OVER () AS doc, doc_id, {_WORDS} AS w FROM documents),
found AS (SELECT doc, i, size, item FROM (
    SELECT doc, i, size, list_slice(w, i, i + size - 1) AS win FROM (
      SELECT doc, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes)) JOIN windows USING (win)),
hits AS (SELECT doc, count(DISTINCT spot) AS n_hit FROM (
  SELECT doc, unnest(range(i, i + size)) AS spot FROM found) GROUP BY doc),
named AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT doc, item FROM found) GROUP BY doc)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc) LEFT JOIN named USING (doc)""",
    "op13_collocations": rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(
    unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w FROM documents),
grams AS (SELECT lang, list_slice(w, i, i + size - 1) AS g, count(*) AS f FROM (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM pieces, range(1, 6) AS s(size)) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE len(g) = 1 GROUP BY lang),
often AS (SELECT lang, g, f FROM grams WHERE f >= 100),
cuts AS (SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM often),
scores AS (SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, n,
    CAST(1000 * c.f::HUGEINT * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score FROM cuts c
  JOIN often l ON l.lang = c.lang AND l.g = list_slice(c.g, 1, k)
  JOIN often r ON r.lang = c.lang AND r.g = list_slice(c.g, k + 1, len(c.g)) JOIN totals ON totals.lang = c.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
covered AS (SELECT DISTINCT lang, list_slice(g, i, i + size - 1) AS g, f FROM (
  SELECT lang, g, f, size, unnest(range(1, len(g) - size + 2)) AS i FROM often, range(2, 5) AS s(size) WHERE size < len(g))),
kept AS (SELECT lowest.*, array_to_string(g, ' ') AS phrase FROM lowest WHERE NOT EXISTS (
  SELECT 1 FROM covered WHERE covered.lang = lowest.lang AND covered.g = lowest.g AND 100 * covered.f >= 100 * lowest.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000""",
}
