"""Registered queries of this package and the SQL that states their answers."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.llm import (
    bitpack,
    chat,
    decontaminate,
    divergence,
    line_templates,
    merkle,
    packing,
    periodic_runs,
    quality_crf,
    simhash,
    superminhash,
    token_counts,
    url_templates,
)
from plotkeep.llm.scratch import kept

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text; of ids divisible by 100, the documents within the radius."""
    rows = simhash.with_edits(read(spark, sf_dir, "documents"))
    rows = kept(rows, "prints")
    prints = rows.groupBy("fp").agg(F.count("*").alias("times"))
    asked = F.col("doc_id") % 100 == 0
    near = simhash.near_counts(prints, rows.where(asked).select("fp"))
    rows = rows.join(near, "fp", "left")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.lpad(F.lower(F.hex("edited_fp")), 16, "0").alias("edited_fingerprint"),
        "near_edited", "near_next", F.when(asked, F.col("near")).alias("n_near"))


_WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op2_decontaminate", rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '{_WORD_SQL}') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '{_WORD_SQL}') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT r, w, unnest(generate_series(1, len(w))) AS s FROM d), sizes WHERE s + n - 1 <= len(w)),
hits AS (SELECT r, item_id, s, dw.n FROM dw JOIN bw USING (n, gram)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT r, cast(item_id AS VARCHAR) AS i FROM hits) GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# How the second replica is damaged: a character changed, or the record lost.
_CHANGED, _LOST = "page_id % 211 = 7", "page_id % 997 = 5"


@query("op3_merkle_fixity", rf"""
WITH r AS (
  SELECT page_id, url, html, cast(floor(coalesce(page_id, -1) / {float(merkle.ARCHIVE_IDS)}) AS BIGINT) AS archive,
         cast(strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: '
           || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
           || cast(strlen(coalesce(html, '')) AS VARCHAR)) + strlen(coalesce(html, '')) + 8 AS BIGINT) AS length
  FROM pages),
o AS (
  SELECT *, coalesce(cast(sum(length) OVER (PARTITION BY archive ORDER BY page_id, url
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start FROM r)
SELECT archive, start AS "offset", length, CASE WHEN {_LOST} THEN 'lost' ELSE 'changed' END AS damage
FROM o WHERE {_CHANGED} OR {_LOST}
""")
def op3_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places where a damaged replica of the pages' archives departs from the first."""
    whole = merkle.warc_record(F.col("url"), F.col("html"))
    spoilt = F.when(F.expr(_CHANGED), F.overlay(whole, F.lit("?").cast("binary"), F.lit(20), F.lit(1))).otherwise(whole)
    records = kept(merkle.laid_out(read(spark, sf_dir, "pages"), whole, other=F.sha2(spoilt, 256)), "records")
    place = ["archive", "offset", "length"]
    one = records.select(*place, "digest")
    two = records.where(F.expr(f"NOT coalesce({_LOST}, false)")).select(*place, F.col("other").alias("digest"))
    return merkle.audit(one, two)


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query("op4_url_templates")
def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url, judged by the rules or by its path template.

    A url is labelled with the quality of the document that its last segment names.
    """
    number = F.regexp_extract(url_templates.path_of(F.col("url")), r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    labels = read(spark, sf_dir, "labels").where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label"))
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.when(number != "", number.cast("long")).alias("doc_id"))
    return url_templates.judged(pages.join(labels, "doc_id", "left"), RULES)


@query("op5_bitpack")
def op5_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written in the file format and read back."""
    images = bitpack.write_images(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return bitpack.read_images(images)


@query("op6_near_duplicates")
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of every document."""
    return superminhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op7_line_templates")
def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template recurs across documents."""
    found = line_templates.without_recurring_lines(read(spark, sf_dir, "documents"))
    return found.select(F.col("_row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "text")


@query("op8_cost_packing")
def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.packed(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, with_ids=False)


_TURNS_SQL = "coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10)"
_ORDER_SQL = "turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')"


@query("op9_chat", rf"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg({_TURNS_SQL}, '' ORDER BY {_ORDER_SQL})) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(coalesce(text, ''), '' ORDER BY {_ORDER_SQL}) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(sum(14 + length(coalesce(role, '')) + length(regexp_replace(coalesce(role, ''), '[^\\#<:]', '', 'g'))
    + length(coalesce(text, '')) + length(regexp_replace(coalesce(text, ''), '[^\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
""")
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one full of marks, formatted and read back."""
    hard = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    said = read(spark, sf_dir, "conversations").select(*[F.col(c).cast(t).alias(c) for c, t in extra.dtypes])
    return chat.read_back(chat.formatted(said.union(extra)))


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the line field, learned outside the held-out fifth."""
    docs = read(spark, sf_dir, "documents")
    field = quality_crf.train(docs, read(spark, sf_dir, "labels"))
    return quality_crf.score(docs.select("doc_id", "text"), field).select(
        "doc_id", quality_crf.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= quality_crf.ACCEPT, 1).otherwise(0).alias("predicted"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which are given a periodic end, and the texts without their repeats."""
    return periodic_runs.periodic_runs(read(spark, sf_dir, "documents"), periodic_runs.repeat_tail, with_text=False)


@query("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it exceeds 512 tokens."""
    counts = token_counts.counted(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def _p13(count: str, total: str) -> str:
    return f"1 + (1000000000 * ({count} + 2)::HUGEINT) // ({total} + 2 * v)"


def _f13(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) // ({p} + {q})"


@query("op13_divergence", rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
    regexp_extract_all({_LOWER_SQL.format("coalesce(text, '')")}, '{divergence.TERM}') AS w
  FROM documents),
t AS (SELECT lang, source, r, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(l.total, 0) AS lang_total,
    coalesce((SELECT sum(n) FROM c WHERE c.lang = s.lang AND c.source = s.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN l USING (lang)),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {_p13("coalesce(c.n, 0)", "g.total")} AS p, {_p13("k.n", "lang_total")} AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    cast(coalesce((SELECT sum({_f13("x.p", "y.p")}) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, cast({_f13("p", "q")} AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
""")
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences between the sources of each language, and the terms that mark each source."""
    return divergence.divergence(read(spark, sf_dir, "documents"))
