"""The queries of this subpackage: each applies one operator with production
parameters to its whole table and returns the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    bpe, conversations, copies, decontam, exactdup, licenses, phrases, quality, secrets, simhash,
    tokens, urls, warc,
)
from tessera.llm.common import read
from tessera.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_byte_bpe(spark, sf_dir):
    coded = bpe.encode_texts(read(spark, sf_dir, "documents"), decoded=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))


@register
def op2_suffix_dedup(spark, sf_dir):
    found = exactdup.remove_repeats(read(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"),
                        F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@register
def op3_license_scan(spark, sf_dir):
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


@register
def op4_secret_scan(spark, sf_dir):
    found = secrets.scan_secrets(read(spark, sf_dir, "documents"))
    told = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    strong = F.filter("spans", lambda s: s["kind"].isin(secrets.STRONG))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.STRONG],
                        F.sha2(told(strong), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))


@register
def op5_simhash_dedup(spark, sf_dir):
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@register
def op6_decontamination(spark, sf_dir):
    found = decontam.contaminated(decontam.match_benchmark(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated")


@register
def op7_token_counts(spark, sf_dir):
    counted = tokens.count_tokens(read(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@register
def op8_warc_archives(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    raw, own = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    warc.write_archives(warc.records(pages), raw)
    warc.normalise(spark, raw, own)
    kind = dict(pages.dtypes)["page_id"]
    return warc.read_archives(spark, own).withColumns(
        {c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


@register
def op9_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    q = quality.measure(docs, rules=quality.RUNNING_TEXT)
    return q.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept")])


@register
def op10_url_filter(spark, sf_dir):
    return urls.judge_urls(read(spark, sf_dir, "pages"))


@register
def op11_phrases(spark, sf_dir):
    return phrases.top_collocations(read(spark, sf_dir, "documents"))


ORACLE["op11_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
counted AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, k AS size, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))
      AS phrase
    FROM ws, range(1, 6) t(k) WHERE len(w) >= k) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
often AS (SELECT * FROM counted WHERE f >= 100),
cand AS (
  SELECT * FROM often c WHERE size > 1 AND NOT EXISTS (
    SELECT 1 FROM often o WHERE o.lang = c.lang AND o.size > c.size AND 100 * o.f >= 100 * c.f
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
         CAST(CAST(1000 AS HUGEINT) * c.f * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cand c, range(1, 5) t(k), often l, often r, total
  WHERE k < c.size AND l.lang = c.lang AND r.lang = c.lang AND total.lang = c.lang
    AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1:k], ' ')
    AND r.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ')),
scored AS (
  SELECT lang, phrase, a, l, r, n, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score FROM scored)
SELECT * FROM ranked WHERE rank <= 2000"""


@register
def op12_conversation_repair(spark, sf_dir):
    return conversations.repair_conversations(conversations.damage(read(spark, sf_dir, "conversations")))


@register
def op13_exact_dedup(spark, sf_dir):
    return copies.find_copies(read(spark, sf_dir, "documents"))


ORACLE["op13_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s FROM documents),
g AS (
  SELECT doc_id, s, first_value(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY s) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM g"""
