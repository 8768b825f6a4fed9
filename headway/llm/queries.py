"""The queries opN_* over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, chat_format, decontam, imatch, langid, shard, simhash, substring, toxicity, url_filter
from headway.llm.common import read_table

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("runs").alias("n_runs"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read_table(spark, sf_dir, "documents"), digest=True)


def tokenizer_spec(path: str | None = None) -> str:
    """The text of a vocabulary file on the driver; by default the public one for words."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_spec()))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shard_documents(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), rules)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.digest(chat_format.format_conversations(rows))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_langid": op1_langid, "op2_simhash": op2_simhash, "op3_substring": op3_substring, "op4_bpe": op4_bpe, "op5_imatch": op5_imatch, "op6_sharding": op6_sharding, "op7_toxicity": op7_toxicity, "op8_url_filter": op8_url_filter, "op9_chat_format": op9_chat_format, "op10_decontamination": op10_decontamination}

OP8_SQL = r"""
WITH split AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(rule_host, rule_path, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
judged AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(action, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM split) s JOIN rules r ON (s.host = rule_host OR ends_with(s.host, '.' || rule_host)) AND starts_with(s.path, rule_path)
  GROUP BY host, path)
SELECT page_id, s.host, s.path, rule, coalesce(verdict, 'allow') AS verdict FROM split s LEFT JOIN judged j ON s.host = j.host AND s.path = j.path
"""

OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
near AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS joined, lead(role) OVER w IS NOT DISTINCT FROM role AS joins,
    regexp_replace(replace(text, '\', '\b'), '<(turn |/turn>|next/>)', '\\l\1', 'g') AS escaped
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(escaped) + CASE WHEN joined THEN 0 ELSE length(role) + 8 END + CASE WHEN joins THEN 7 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM near GROUP BY conv_id
"""

ORACLES = {"op8_url_filter": OP8_SQL, "op9_chat_format": OP9_SQL}
