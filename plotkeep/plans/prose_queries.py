"""Queries over documents and pages: quoted numbers, dated claims, links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.functions import prose as P
from plotkeep.operators import gates
from plotkeep.plans.registry import query, table

# claims are added to whole texts, because the texts themselves hold almost none
_FENCED = "'```' || chr(10) || 'select 9,999 -- 2024-01-01' || chr(10) || '```' || chr(10)"
CLAIMS = (
    "CASE WHEN doc_id % 4 = 0 THEN text || ' The table holds 1,234 rows.' "
    "WHEN doc_id % 4 = 1 THEN text || ' Some 94% of them match.' || chr(10) || 'See ' || n_chars || ' below.' "
    "WHEN doc_id % 4 = 2 THEN text || ' Extracted 2024-05-06.' "
    f"ELSE {_FENCED} || text || ' The first version is from 2024-01-02. Written in 2023 by hand.' END"
)
SQL_PROSE = f"""
    claims AS (SELECT doc_id, {CLAIMS} AS t FROM documents),
    prose AS (SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN repeat(chr(10), 2) || substr(t, length({_FENCED}))
                             ELSE t END AS t FROM claims)
"""


def documents_with_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = F.expr(CLAIMS.replace("n_chars", "cast(n_chars AS STRING)"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return docs.select(F.col("doc_id").alias("path"), claims.alias("text"))


@query(
    "fence_removal",
    f"""
    WITH {SQL_PROSE}
    SELECT doc_id AS path, md5(t) AS prose_md5, length(t) - length(replace(t, chr(10), '')) AS newlines FROM prose
    """,
)
def fence_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    prose = P.blank_fences(F.col("text"))
    docs = documents_with_claims(spark, sf_dir).select("path", prose.alias("t"))
    return docs.select("path", F.md5("t").alias("prose_md5"), P.newlines(F.col("t")).cast("long").alias("newlines"))


@query(
    "doc_numbers",
    f"""
    WITH {SQL_PROSE},
         lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l,
                          generate_subscripts(string_split(t, chr(10)), 1) AS line FROM prose),
         -- separators are doubled, because each match also consumes the one on either side
         wide AS (SELECT doc_id, line, ' ' || regexp_replace(l, '([^\\pL\\pN\\pM_.,%])', '\\1\\1', 'g') || ' ' AS l
                  FROM lines),
         found AS (SELECT doc_id, line, unnest(regexp_extract_all(l,
                     '[^\\pL\\pN\\pM_.](\\d{{1,3}}(?:,\\d{{3}})+(?:\\.\\d+)?)[^\\pL\\pN\\pM_]|(\\d+(?:\\.\\d+)?%)', 0)) AS v
                   FROM wide),
         named AS (SELECT doc_id, line, regexp_extract(v, '\\d[\\d.,]*%?', 0) AS v FROM found),
         counts AS (SELECT DISTINCT cast(n_chars AS VARCHAR) AS c FROM documents WHERE n_chars >= 100),
         tokens AS (SELECT doc_id, line, unnest(regexp_extract_all(l,
                      '[^\\pL\\pN\\pM_.,]\\d+[^\\pL\\pN\\pM_,]', 0)) AS v FROM wide)
    SELECT doc_id AS path, line, v AS "value" FROM named WHERE v <> '200,000'
    UNION ALL
    SELECT doc_id, line, regexp_extract(v, '\\d+', 0) FROM tokens
    WHERE v NOT LIKE '%\\%' ESCAPE '\\' AND regexp_extract(v, '\\d+', 0) IN (SELECT c FROM counts)
    """,
)
def doc_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted numbers, and the recorded lengths of any document."""
    counts = table(spark, sf_dir, "documents").select(F.col("n_chars").alias("recorded")).where("recorded >= 100")
    return gates.prose_numbers(documents_with_claims(spark, sf_dir), counts.distinct())


@query(
    "doc_dates",
    f"""
    WITH {SQL_PROSE},
         marked AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t,
                        '([.!?]\\s+)', '\\1' || chr(1), 'g'), '(\\n\\s*\\n)', '\\1' || chr(1), 'g'),
                        '(\\n)(\\s*(?:[-*#|]|\\d+\\.\\s))', '\\1' || chr(1) || '\\2', 'g') AS t FROM prose),
         pieces AS (SELECT doc_id, string_split(t, chr(1)) AS p FROM marked),
         sentences AS (SELECT doc_id, p, unnest(p) AS s, generate_subscripts(p, 1) AS i FROM pieces),
         claims2 AS (SELECT doc_id, p, i, s, coalesce(
             nullif(regexp_extract(s, '(?:^|[^\\w/-])((?:19|20)\\d\\d-\\d\\d-\\d\\d)(?:$|[^\\w-])', 1), ''),
             nullif(regexp_extract(s,
               '(?i)\\b(?:extracted|written|retrieved|downloaded|fetched|as of)\\b[^.\\n]{{0,60}}?\\b(?:19|20)\\d\\d\\b', 0),
               '')) AS claim
           FROM sentences WHERE NOT regexp_matches(s, '(?i)\\bfirst (?:version|one|extract)\\b')
                            AND regexp_matches(s, '(?:19|20)\\d\\d'))
    SELECT doc_id AS path, claim, trim(s) AS sentence,
           1 + length(array_to_string(p[1:i-1], '')) - length(replace(array_to_string(p[1:i-1], ''), chr(10), '')) AS line
    FROM claims2 WHERE claim IS NOT NULL
    """,
)
def doc_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.dated_claims(documents_with_claims(spark, sf_dir)).select("path", "claim", "sentence", "line")


URL_PATH = r"^https?://[^/]+/([^?#]*)"
SQL_LINKS = """
    p AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^?#]*)', 1) AS path, html FROM pages),
    inventory AS (SELECT DISTINCT trim(path, '/') AS path FROM p UNION SELECT DISTINCT split_part(path, '/', 1) FROM p),
    hrefs AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM p),
    broken AS (SELECT page_id, trim(href, '/') AS target FROM hrefs
               WHERE href <> '' AND href NOT LIKE '%://%' AND href NOT LIKE '#%' AND href NOT LIKE 'mailto:%'
                 AND trim(href, '/') NOT IN (SELECT path FROM inventory))
"""


def page_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Links of every page, and the crawled paths with their first folders."""
    pages = table(spark, sf_dir, "pages").withColumn("path", F.regexp_extract("url", URL_PATH, 1))
    inventory = pages.select(F.trim("path", F.lit("/")).alias("path")).unionByName(
        pages.select(F.substring_index("path", "/", 1).alias("path"))
    )
    links = pages.select("page_id", F.lit("").alias("doc_dir"), F.explode(P.html_links(F.col("html"))).alias("href"))
    return links, inventory.distinct()


@query("link_resolution", f"WITH {SQL_LINKS} SELECT target, count(*) AS referring FROM broken GROUP BY target")
def link_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.unresolved_links(*page_links(spark, sf_dir))


@query(
    "broken_references",
    f"WITH {SQL_LINKS} SELECT page_id, target, count(*) AS mentions FROM broken GROUP BY page_id, target",
)
def broken_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = gates.broken_references(*page_links(spark, sf_dir), "page_id")
    return broken.groupBy("page_id", "target").agg(F.count(F.lit(1)).alias("mentions"))
