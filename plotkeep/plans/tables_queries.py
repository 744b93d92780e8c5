"""Queries over attribute tables: decoding, cleaning, profiles, hashes, gates.

The tables hold one version, no orphans and few nulls. Where an operator needs
a second version, a defect or a missing value, it is derived from the whole
table by arithmetic on the key, the same in Spark and in SQL; such a condition
marks or edits rows and never narrows what a query works on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.functions import clean as C
from plotkeep.operators import content, gates, keys, legend, objects, profile
from plotkeep.plans.registry import query, sql_content_hash, sql_row_text, table
from plotkeep.session import scratch_path
from plotkeep.sources import documents as D
from plotkeep.sources import pages as P
from plotkeep.sources.inventory import list_files

ORPHAN_CUSTOMER = "CASE WHEN o_orderkey % 19 = 0 THEN o_custkey + 1000000 ELSE o_custkey END"


@query(
    "decode_join_count",
    """
    SELECT p_brand, p_type, count(*) AS n
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_brand, p_type
    """,
)
def decode_join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.decoded_counts(
        table(spark, sf_dir, "lineitem"), "l_partkey", table(spark, sf_dir, "part"), "p_partkey", ["p_brand", "p_type"]
    )


@query(
    "unmatched_codes",
    f"""
    SELECT 'order_customer' AS check_name, {ORPHAN_CUSTOMER} AS code, count(*) AS n
    FROM orders WHERE {ORPHAN_CUSTOMER} NOT IN (SELECT c_custkey FROM customer) GROUP BY ALL
    UNION ALL
    SELECT 'order_lines' AS check_name, o_orderkey AS code, count(*) AS n
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL
    """,
)
def unmatched_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lost = keys.unmatched_codes(orders, F.expr(ORPHAN_CUSTOMER), table(spark, sf_dir, "customer"), "c_custkey")
    bare = keys.unmatched_codes(orders, F.col("o_orderkey"), table(spark, sf_dir, "lineitem"), "l_orderkey")
    return lost.select(F.lit("order_customer").alias("check_name"), "code", "n").unionByName(
        bare.select(F.lit("order_lines").alias("check_name"), "code", "n")
    )


def _sql_match_rate(pair: str, left: str, right: str) -> str:
    both = f"(SELECT count(*) FROM (SELECT k FROM {left} INTERSECT SELECT k FROM {right}))"
    return " UNION ALL ".join(
        f"SELECT '{pair}' AS pair, '{direction}' AS direction, count(DISTINCT k) AS distinct_keys, "
        f"{both} AS matched_keys, round({both} / count(DISTINCT k), 6) AS match_rate FROM {side}"
        for direction, side in (("left_to_right", left), ("right_to_left", right))
    )


@query(
    "key_match_rate",
    f"""
    WITH users AS (SELECT user_id AS k FROM events),
         customers AS (SELECT c_custkey AS k FROM customer),
         buyers AS (SELECT {ORPHAN_CUSTOMER} AS k FROM orders)
    {_sql_match_rate("event_user", "users", "customers")}
    UNION ALL {_sql_match_rate("order_customer", "buyers", "customers")}
    """,
)
def key_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    pairs = {
        "event_user": (table(spark, sf_dir, "events"), F.col("user_id")),
        "order_customer": (table(spark, sf_dir, "orders"), F.expr(ORPHAN_CUSTOMER)),
    }
    rates = [
        keys.key_match_rate(df, key, customer, F.col("c_custkey")).select(
            F.lit(name).alias("pair"), "direction", "distinct_keys", "matched_keys", "match_rate"
        )
        for name, (df, key) in pairs.items()
    ]
    return rates[0].unionByName(rates[1])


SEGMENT_WITH_TOKENS = (
    "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'null' "
    "WHEN c_custkey % 17 = 0 THEN 'NULL' ELSE c_mktsegment END"
)


@query(
    "null_token_cleanup",
    f"""
    SELECT CASE WHEN s IN ('null', 'NULL') THEN NULL ELSE s END AS segment, count(*) AS n
    FROM (SELECT {SEGMENT_WITH_TOKENS} AS s FROM customer) GROUP BY 1
    """,
)
def null_token_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select(F.expr(SEGMENT_WITH_TOKENS).alias("s"))
    return raw.groupBy(C.null_tokens_to_null(F.col("s")).alias("segment")).agg(F.count(F.lit(1)).alias("n"))


MULTI_VALUE = "CASE WHEN p_partkey % 5 = 0 THEN replace(p_name, ' ', ' ;; ') || ';' ELSE replace(p_name, ' ', ';') END"


@query(
    "multivalue_explode_count",
    f"""
    SELECT item, count(*) AS n
    FROM (SELECT trim(unnest(string_split({MULTI_VALUE}, ';'))) AS item FROM part)
    WHERE item <> '' GROUP BY item
    """,
)
def multivalue_explode_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.item_counts(table(spark, sf_dir, "part").select(F.expr(MULTI_VALUE).alias("kinds")), "kinds")


@query(
    "unit_totals",
    f"""
    WITH p AS (SELECT p_brand, {MULTI_VALUE} AS kinds, p_size AS total_units, p_size % 7 AS accessible_units FROM part),
         split AS (SELECT p_brand, trim(unnest(string_split(kinds, ';'))) AS item, total_units, accessible_units FROM p)
    SELECT p_brand, item, cast(sum(total_units) AS BIGINT) AS total_units,
           cast(sum(accessible_units) AS BIGINT) AS accessible_units
    FROM split WHERE item <> '' GROUP BY p_brand, item
    UNION ALL
    SELECT p_brand, '(all)', cast(sum(total_units) AS BIGINT), cast(sum(accessible_units) AS BIGINT)
    FROM p GROUP BY p_brand
    """,
)
def unit_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        "p_brand", F.expr(MULTI_VALUE).alias("kinds"),
        F.col("p_size").alias("total_units"), (F.col("p_size") % 7).alias("accessible_units"),
    )
    return keys.unit_totals(part, "kinds", ["p_brand"], ["total_units", "accessible_units"])


SIZE_LABEL = "CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE cast(p_size AS {text}) END"


@query(
    "derive_codebook",
    f"""
    WITH labelled AS (
      SELECT p_size AS code, {SIZE_LABEL.format(text="VARCHAR")} AS label FROM part),
    counted AS (
      SELECT code, label, count(*) AS n FROM labelled
      WHERE label IS NOT NULL AND NOT regexp_full_match(trim(label), '\\d*') GROUP BY code, label)
    SELECT code, label, n FROM counted
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY n DESC, label) = 1
    """,
)
def derive_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("described", F.expr(SIZE_LABEL.format(text="STRING")))
    return keys.code_book(part, "p_size", "described")


LINE_BOOK = {1: "first", 2: "second", 3: "third", 4: "fourth", 5: "fifth"}


@query(
    "decode_labels",
    """
    SELECT CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third'
           WHEN 4 THEN 'fourth' WHEN 5 THEN 'fifth' END AS label, count(*) AS n
    FROM lineitem GROUP BY 1
    """,
)
def decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = C.code_label(F.col("l_linenumber"), LINE_BOOK)
    return table(spark, sf_dir, "lineitem").groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "float_range_ranks",
    """
    WITH noisy AS (SELECT l_discount + l_tax / 1000 AS d FROM lineitem)
    SELECT CASE WHEN abs(d - 0.02) < 0.0005 THEN 0.02 WHEN abs(d - 0.04) < 0.0005 THEN 0.04
                WHEN abs(d - 0.06) < 0.0005 THEN 0.06 WHEN abs(d - 0.08) < 0.0005 THEN 0.08 END::DOUBLE AS rank,
           count(*) AS n
    FROM noisy GROUP BY 1
    """,
)
def float_range_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = table(spark, sf_dir, "lineitem").select((F.col("l_discount") + F.col("l_tax") / 1000).alias("d"))
    rank = C.snap_to(F.col("d"), (0.02, 0.04, 0.06, 0.08), 5e-4)
    return noisy.groupBy(rank.alias("rank")).agg(F.count(F.lit(1)).alias("n"))


STREET = "cast(c_custkey % 500 AS {text}) || ' ' || c_mktsegment || ' street'"


@query(
    "address_join",
    f"""
    WITH a AS (SELECT c_custkey, {STREET.format(text="VARCHAR")} AS addr FROM customer),
         l AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '  ' || lower(addr) || ' '
                                      ELSE replace(addr, ' ', '   ') END AS addr FROM a WHERE c_custkey % 3 <> 0
               UNION ALL SELECT c_custkey, addr || ' rear' FROM a WHERE c_custkey % 3 = 0),
         r AS (SELECT upper(addr) AS k, count(*) AS matches, min(c_custkey) AS first_match FROM a GROUP BY 1)
    SELECT c_custkey, upper(trim(regexp_replace(addr, '\\s+', ' ', 'g'))) AS address_key,
           coalesce(matches, 0) AS matches, first_match
    FROM l LEFT JOIN r ON upper(trim(regexp_replace(addr, '\\s+', ' ', 'g'))) = k
    """,
)
def address_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = table(spark, sf_dir, "customer").select("c_custkey", F.expr(STREET.format(text="STRING")).alias("addr"))
    noisy = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat("addr", F.lit(" rear")))
        .when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("  "), F.lower("addr"), F.lit(" ")))
        .otherwise(F.replace("addr", F.lit(" "), F.lit("   ")))
    )
    left = clean.select("c_custkey", noisy.alias("addr"))
    return keys.match_by_address(left, "addr", "c_custkey", clean, "addr", "c_custkey").drop("addr")


def _sql_values(column: str, numeric: bool) -> str:
    num, text = (column, "NULL") if numeric else ("NULL", column)
    return (
        f"SELECT '{column}' AS \"column\", cast({num} AS DOUBLE) AS num, cast({text} AS VARCHAR) AS str, "
        f"count(*) AS n FROM lineitem WHERE {column} IS NOT NULL GROUP BY {column}"
    )


@query(
    "distinct_value_counts",
    " UNION ALL ".join(
        _sql_values(c, numeric)
        for c, numeric in (("l_returnflag", 0), ("l_linestatus", 0), ("l_linenumber", 1), ("l_quantity", 1))
    ),
)
def distinct_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_value_counts(
        table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]
    )


PRICE_STOPS = (50000.0, 100000.0, 200000.0, 400000.0, 900000000.0)
ODD_PRICE = (
    "CASE WHEN o_orderkey % 23 = 0 THEN cast('NaN' AS DOUBLE) WHEN o_orderkey % 29 = 0 THEN cast('Infinity' AS DOUBLE) "
    "WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice END"
)


@query(
    "step_histogram",
    f"""
    WITH v AS (SELECT {ODD_PRICE} AS v FROM orders),
         c AS (SELECT cast((v >= 50000)::INT + (v >= 100000)::INT + (v >= 200000)::INT + (v >= 400000)::INT
                      + (v >= 900000000)::INT AS INT) AS class_index, count(*) AS n
               FROM v WHERE v IS NOT NULL AND NOT isnan(v) AND NOT isinf(v) GROUP BY 1),
         k AS (SELECT * FROM (VALUES (0, NULL, 50000.0::DOUBLE), (1, 50000.0, 100000.0), (2, 100000.0, 200000.0),
               (3, 200000.0, 400000.0), (4, 400000.0, 900000000.0), (5, 900000000.0, NULL)) t(class_index, low, high))
    SELECT class_index, low::DOUBLE AS low, high::DOUBLE AS high, coalesce(n, 0) AS n, n IS NULL AS empty
    FROM k LEFT JOIN c USING (class_index)
    """,
)
def step_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.step_histogram(table(spark, sf_dir, "orders"), F.expr(ODD_PRICE), PRICE_STOPS)


HASHED = {
    "customer": (("c_custkey", "int"), ("c_name", "text"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "text")),
    "orders": (("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "text"), ("o_totalprice", "double"),
               ("o_orderdate", "time"), ("o_orderpriority", "text")),
    "lineitem": (("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "text"), ("l_linestatus", "text"), ("l_shipdate", "time")),
    "events": (("event_id", "int"), ("ts", "time"), ("user_id", "int"), ("event_type", "text"), ("value", "double"),
               ("props", "text")),
    "documents": (("doc_id", "int"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "int")),
}


@query(
    "content_hash_portable",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {sql_content_hash(sql_row_text(*cols))} AS content_hash FROM {name}"
        for name, cols in HASHED.items()
    ),
)
def content_hash_portable(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, columns in HASHED.items():
        rows = table(spark, sf_dir, name).select(*[c for c, _ in columns])
        one = content.content_hash(rows, portable=True)
        one = one.select(F.lit(name).alias("table_name"), "content_hash")
        out = one if out is None else out.unionByName(one)
    return out


ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query(
    "content_hash_fast",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, true AS same_when_dealt_anew, true AS other_when_repeated, "
        f"true AS other_when_nulled FROM {name}" for name in ALL_TABLES
    ),
)
def content_hash_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the engine's own hash must tell apart; its values no other engine can repeat."""
    out = None
    for name in ALL_TABLES:
        rows = table(spark, sf_dir, name)
        key = rows.columns[0]
        least = rows.agg(F.min(key).alias("_least"))
        one = rows.join(F.broadcast(least), F.col(key) == F.col("_least"))  # the rows of the smallest key
        nulled = rows.join(F.broadcast(least), F.col(key) == F.col("_least"), "left").withColumn(
            key, F.when(F.col("_least").isNull(), F.col(key))).drop("_least")
        forms = [rows, rows.repartition(*rows.columns), rows.union(one.drop("_least")), nulled]
        hashed = None
        for i, df in enumerate(forms):
            hash_row = content.content_hash(df).select(F.lit(name).alias("table_name"), F.lit(i).alias("form"), "content_hash")
            hashed = hash_row if hashed is None else hashed.union(hash_row)
        found = [F.max(F.when(F.col("form") == i, F.col("content_hash"))).alias(f"h{i}") for i in range(len(forms))]
        both = hashed.groupBy("table_name").agg(*found).select(
            "table_name", F.split_part("h0", F.lit(":"), F.lit(2)).cast("long").alias("row_count"),
            (F.col("h0") == F.col("h1")).alias("same_when_dealt_anew"), (F.col("h0") != F.col("h2")).alias("other_when_repeated"),
            (F.col("h0") != F.col("h3")).alias("other_when_nulled"))
        out = both if out is None else out.unionByName(both)
    return out


@query(
    "table_facts",
    """
    SELECT count(*) AS row_count, cast(6 AS BIGINT) AS column_count, round(min(value), 10) AS xmin,
           cast(min(user_id % 100) AS DOUBLE) AS ymin, round(max(value), 10) AS xmax,
           cast(max(user_id % 100) AS DOUBLE) AS ymax
    FROM events
    """,
)
def table_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("value"), (F.col("user_id") % 100).cast("double")
    return profile.table_facts(table(spark, sf_dir, "events"), x, y, x, y)


@query(
    "schema_diff",
    """
    WITH n AS (SELECT count(*) AS n FROM customer)
    SELECT * FROM (
      SELECT 'c_custkey' AS "column", 'bigint' AS old_type, n AS old_filled, 'bigint' AS new_type, n AS new_filled,
             'same' AS change FROM n
      UNION ALL SELECT 'c_name', 'string', n, 'string', n, 'same' FROM n
      UNION ALL SELECT 'c_nationkey', 'int', n, NULL, NULL, 'removed' FROM n
      UNION ALL SELECT 'c_acctbal', 'double', n, 'string', n, 'retyped' FROM n
      UNION ALL SELECT 'c_mktsegment', 'string', n, 'string', (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0),
             'same' FROM n
      UNION ALL SELECT 'place', NULL, NULL, 'struct<nation:int>', n, 'added' FROM n
      UNION ALL SELECT 'place.nation', NULL, NULL, 'int', n, 'added' FROM n)
    """,
)
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer")
    new = old.select(
        "c_custkey", "c_name", F.col("c_acctbal").cast("string").alias("c_acctbal"),
        F.expr("CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END").alias("c_mktsegment"),
        F.struct(F.col("c_nationkey").alias("nation")).alias("place"),
    )
    return profile.schema_diff(old, new)


@query(
    "row_parity",
    """
    SELECT o_orderpriority AS collection, count(*) AS before,
           count(*) FILTER (WHERE NOT (o_orderpriority = '2-HIGH' AND o_orderkey % 17 = 0)) AS after,
           count(*) FILTER (WHERE NOT (o_orderpriority = '5-LOW' AND o_orderkey % 23 = 0)) AS written,
           count(*) = count(*) FILTER (WHERE NOT (o_orderpriority = '2-HIGH' AND o_orderkey % 17 = 0))
           AND count(*) = count(*) FILTER (WHERE NOT (o_orderpriority = '5-LOW' AND o_orderkey % 23 = 0)) AS ok
    FROM orders GROUP BY o_orderpriority
    """,
)
def row_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two priorities lose rows on purpose: one at the source, one while writing."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("collection"), "o_orderkey")

    def counted(df: DataFrame) -> DataFrame:
        return df.groupBy("collection").agg(F.count(F.lit(1)).alias("n"))

    after = orders.where("not (collection = '2-HIGH' and o_orderkey % 17 = 0)")
    written = orders.where("not (collection = '5-LOW' and o_orderkey % 23 = 0)")
    return profile.row_parity(counted(orders), counted(after), counted(written))


EDITED_CUSTOMER = """
    SELECT c_custkey, c_name, c_nationkey,
           c_acctbal + CASE WHEN c_nationkey % 3 = 1 AND c_custkey % 10 = 0 THEN 1 ELSE 0 END AS c_acctbal,
           c_mktsegment
    FROM {t}
    UNION ALL
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {t}
    WHERE c_nationkey % 3 = 2 AND c_custkey % 40 = 0
"""
_CUSTOMER_HASH = sql_content_hash(
    sql_row_text(("c_custkey", "int"), ("c_name", "text"), ("c_acctbal", "double"), ("c_mktsegment", "text"))
)


@query(
    "no_op_checks",
    f"""
    WITH e AS ({EDITED_CUSTOMER.format(t="customer")}),
         old AS (SELECT c_nationkey AS collection, {_CUSTOMER_HASH} AS current_hash FROM customer GROUP BY 1),
         new AS (SELECT c_nationkey AS collection, {_CUSTOMER_HASH} AS extracted_hash FROM e GROUP BY 1)
    SELECT collection, extracted_hash, current_hash, extracted_hash = current_hash AS no_op
    FROM new JOIN old USING (collection)
    """,
)
def no_op_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the collections is edited, a third repeats rows, a third only changes order."""
    current = table(spark, sf_dir, "customer")
    current.createOrReplaceTempView("plotkeep_customer")
    extracted = spark.sql(EDITED_CUSTOMER.format(t="plotkeep_customer")).repartition("c_mktsegment")

    def hashed(df: DataFrame) -> DataFrame:
        return content.content_hash(df.withColumnRenamed("c_nationkey", "collection"), by=["collection"], portable=True)

    return content.no_op_checks(hashed(current), hashed(extracted))


@query(
    "advanced_hash",
    f"""
    WITH v2 AS (
      SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS c_acctbal, c_mktsegment, c_nationkey
      FROM customer WHERE c_custkey % 17 <> 0 AND c_nationkey <> 3
      UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_nationkey FROM customer
                WHERE c_custkey % 41 = 0 AND c_custkey % 17 <> 0 AND c_nationkey <> 3
      UNION ALL SELECT c_custkey + 100000000, c_name, c_acctbal, c_mktsegment, 1000 FROM customer WHERE c_custkey % 50 = 0)
    SELECT c_nationkey, {_CUSTOMER_HASH} AS content_hash FROM v2 GROUP BY c_nationkey
    """,
)
def advanced_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes per nation kept up by what version two edits, removes, repeats and adds; one nation goes, one comes."""
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_nationkey"]
    old = table(spark, sf_dir, "customer").select(columns)
    edited = F.col("c_acctbal") + F.when(F.col("c_custkey") % 10 == 0, 1).otherwise(0)
    left = old.where("c_custkey % 17 <> 0 and c_nationkey <> 3")
    came = old.where("c_custkey % 50 = 0").withColumns(
        {"c_custkey": F.col("c_custkey") + 100000000, "c_nationkey": F.lit(1000).cast(old.schema["c_nationkey"].dataType)})
    new = left.withColumn("c_acctbal", edited).union(left.where("c_custkey % 41 = 0")).union(came)
    before = content.content_hash(old, by=["c_nationkey"], portable=True)
    diff = content.version_diff(old, new, ["c_custkey"])
    return content.advance_hash(before, *content.changed_rows(old, new, diff, ["c_custkey"]), by=["c_nationkey"], portable=True)


@query(
    "version_diff",
    """
    WITH v2 AS (
      SELECT c_custkey, c_name, c_acctbal + CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS c_acctbal
      FROM customer WHERE c_custkey % 17 <> 0
      UNION ALL SELECT c_custkey + 100000000, c_name, c_acctbal FROM customer WHERE c_custkey % 50 = 0)
    SELECT * FROM (
      SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
             CASE WHEN a.c_custkey IS NULL THEN 'added' WHEN b.c_custkey IS NULL THEN 'removed'
                  WHEN a.c_acctbal <> b.c_acctbal THEN 'changed' END AS change
      FROM customer a FULL JOIN v2 b ON a.c_custkey = b.c_custkey)
    WHERE change IS NOT NULL
    """,
)
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version two edits, removes and adds rows."""
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    edited = F.col("c_acctbal") + F.when(F.col("c_custkey") % 10 == 0, 1).otherwise(0)
    kept = old.where("c_custkey % 17 <> 0").withColumn("c_acctbal", edited)
    added = old.where("c_custkey % 50 = 0").withColumn("c_custkey", F.col("c_custkey") + 100000000)
    return content.version_diff(old, kept.unionByName(added), ["c_custkey"])


@query(
    "replace_and_top",
    """
    WITH lower_flag AS (SELECT l_partkey, lower(l_returnflag) AS l_returnflag, l_quantity FROM lineitem),
         returned AS (SELECT DISTINCT l_partkey FROM lower_flag WHERE l_returnflag = 'r' AND l_quantity >= 45),
         never AS (SELECT cast(p_partkey AS VARCHAR) AS entry FROM part
                   WHERE p_partkey NOT IN (SELECT l_partkey FROM returned))
    SELECT entry, more FROM (SELECT entry, cast(NULL AS BIGINT) AS more FROM never ORDER BY entry LIMIT 20)
    UNION ALL
    SELECT NULL, count(*) - 20 FROM never HAVING count(*) > 20
    """,
)
def replace_and_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.lower("l_returnflag"))
    returned = lines.where("l_returnflag = 'r' and l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey")).distinct()
    never = table(spark, sf_dir, "part").select("p_partkey").join(returned, "p_partkey", "left_anti")
    return objects.head_report(never, "p_partkey")


@query(
    "district_rollup",
    """
    SELECT n_name, c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS mean
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment
    """,
)
def district_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return keys.rollup_by(named, ["n_name", "c_mktsegment"], "c_acctbal")


@query(
    "edit_times",
    """
    WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events),
         p AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 0 ELSE ms END AS data_ms,
               ms - 86400000 AS edit_ms FROM e)
    SELECT event_id, strftime(make_timestamp(coalesce(nullif(data_ms, 0), edit_ms) * 1000), '%Y-%m-%dT%H:%M:%SZ')
           AS last_edit, coalesce(nullif(data_ms, 0), edit_ms) AS edit_ms
    FROM p
    """,
)
def edit_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    data_ms = F.when(F.col("event_id") % 5 == 0, None).when(F.col("event_id") % 7 == 0, 0).otherwise(ms)
    probes = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_id").cast("string").alias("collection"),
        data_ms.alias("data_edit_ms"), (ms - 86400000).alias("edit_ms"),
    )
    known = C.first_known(F.col("data_edit_ms"), F.col("edit_ms"))
    edit = C.utc_from_millis(known)
    return probes.select("event_id", C.iso_utc(edit).alias("last_edit"), known.alias("edit_ms"))


# suffixes and folders that exercise every rule of the classifier
_SUFFIXES = (".json", ".style.json", ".parquet", ".PARQUET", ".pmtiles", ".md", ".tif", ".laz", ".parquet.tmp", "",
             ".geojson", ".unknown", ".png")
_FOLDERS = ("a", "versions", "styles", ".work", "tiles/versions")
_PATH = (
    "source || '/' || list_value({folders})[1 + doc_id % {nf}] || '/d' || cast(doc_id AS VARCHAR) || "
    "list_value({suffixes})[1 + (doc_id // {nf}) % {ns}]"
).format(
    folders=", ".join(f"'{f}'" for f in _FOLDERS), nf=len(_FOLDERS),
    suffixes=", ".join(f"'{s}'" for s in _SUFFIXES), ns=len(_SUFFIXES),
)


@query(
    "path_classification",
    f"""
    WITH p AS (SELECT doc_id, {_PATH} AS path FROM documents),
         s AS (SELECT doc_id, path, lower(regexp_extract(path, '[^/](\\.[^./]+)$', 1)) AS suffix FROM p)
    SELECT doc_id, 'base/' || path AS "key",
           CASE WHEN path LIKE '%.json' AND (path LIKE '%.style.json' OR path LIKE '%/styles/%')
                  THEN 'application/vnd.mapbox.style+json'
                WHEN suffix = '.json' THEN 'application/json'
                WHEN suffix = '.parquet' THEN 'application/vnd.apache.parquet'
                WHEN suffix = '.pmtiles' THEN 'application/vnd.pmtiles'
                WHEN suffix = '.md' THEN 'text/markdown; charset=utf-8'
                WHEN suffix = '.tif' THEN 'image/tiff; application=geotiff'
                WHEN suffix = '.laz' THEN 'application/vnd.laszip'
                WHEN suffix = '.geojson' THEN 'application/geo+json'
                WHEN suffix = '.png' THEN 'image/png'
                ELSE 'application/octet-stream' END AS content_type,
           path LIKE '%/versions/%' AS is_archive,
           suffix IN ('.parquet', '.pmtiles', '.tif', '.tiff', '.laz') AND path NOT LIKE '%/.%' AS publishable,
           's3://' || 'bucket' || doc_id % 3 || '/' AS uri, 'bucket' || doc_id % 3 AS bucket
    FROM s
    """,
)
def path_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = F.get(F.array(*[F.lit(f) for f in _FOLDERS]), (F.col("doc_id") % len(_FOLDERS)).cast("int"))
    turn = F.floor(F.col("doc_id") / len(_FOLDERS)) % len(_SUFFIXES)
    ending = F.get(F.array(*[F.lit(s) for s in _SUFFIXES]), turn.cast("int"))
    paths = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat("source", F.lit("/"), folder, F.lit("/d"), F.col("doc_id").cast("string"), ending).alias("path")
    )
    path = F.col("path")
    uri = F.concat(F.lit("s3://bucket"), (F.col("doc_id") % 3).cast("string"), F.lit("/"))
    return paths.select(
        "doc_id",
        C.object_key("base", path).alias("key"),
        C.content_type(path).alias("content_type"),
        C.is_archive_key(path).alias("is_archive"),
        C.is_data_object(path).alias("publishable"),
        uri.alias("uri"),
        C.split_bucket_uri(uri)[0].alias("bucket"),
    )


@query(
    "inventory_listing",
    """
    SELECT '_assets/orders/year=' || year(o_orderdate) || '/month=' || month(o_orderdate) AS folder,
           cast(1 AS BIGINT) AS files, true AS filled
    FROM orders GROUP BY year(o_orderdate), month(o_orderdate)
    UNION ALL SELECT 'customers/segment=' || c_mktsegment, cast(1 AS BIGINT), true FROM customer GROUP BY c_mktsegment
    """,
)
def inventory_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data files per folder of a published tree; what is staged below a dot folder is not listed."""
    root = scratch_path(spark, "published")
    months = table(spark, sf_dir, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    segments = table(spark, sf_dir, "customer").withColumn("segment", F.col("c_mktsegment"))
    for name, rows, by in (
        ("_assets/orders", months, ["year", "month"]), ("customers", segments, ["segment"]), (".staging/orders", months, ["year"]),
    ):
        # all rows of a folder in one task, so one file each
        rows.repartition(*by).write.partitionBy(*by).parquet(f"{root}/{name}")
    listed = list_files(spark, root).where(C.is_data_object(F.col("path")))
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    return listed.groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.bool_and(F.col("size") > 0).alias("filled"))


@query(
    "accepted_findings",
    """
    SELECT event_id, 'rule-' || user_id % 20 AS rule FROM events
    WHERE event_type IN ('error', 'purchase') AND user_id % 20 NOT IN (SELECT r_regionkey * 3 FROM region)
    """,
)
def accepted_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.concat(F.lit("rule-"), (F.col("user_id") % 20).cast("string"))
    severity = F.when(F.col("event_type").isin("error", "purchase"), "error").otherwise("warning")
    findings = table(spark, sf_dir, "events").select("event_id", rule.alias("rule"), severity.alias("severity"))
    accepted = table(spark, sf_dir, "region").select(
        F.concat(F.lit("rule-"), (F.col("r_regionkey") * 3).cast("string")).alias("rule")
    )
    return gates.blocking_findings(findings, accepted).select("event_id", "rule")


@query(
    "declared_profiles",
    """
    SELECT doc_id, doc_id % 4 IN (0, 1) AS declares FROM documents
    """,
)
def declared_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile URIs: two good forms, a wrong version, and no extension at all."""
    base = F.concat(F.lit("https://schemas.example.org/profile/v1."), (F.col("doc_id") % 9).cast("string"))
    uri = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(base, F.lit(".0/schema.json")))
        .when(F.col("doc_id") % 4 == 1, F.concat(base, F.lit(".0/schema.json#")))
        .when(F.col("doc_id") % 4 == 2, F.concat(base, F.lit("/schema.json")))
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array(F.col("source"), uri).alias("extensions"))
    pattern = r"https://schemas\.example\.org/profile/v\d+\.\d+\.\d+/schema\.json"
    return gates.declares_profile(docs, pattern).select("doc_id", "declares")


@query(
    "object_digest",
    """
    SELECT doc_id, strlen(text) AS size, md5(text) AS md5, '1220' || sha256(text) AS multihash FROM documents
    """,
)
def object_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text").cast("binary")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.octet_length("text").cast("long").alias("size"), C.md5_hex(body).alias("md5"),
        C.multihash(body).alias("multihash"),
    )


ORDER_FIELDS = (
    ("o_orderkey", "esriFieldTypeOID"), ("o_custkey", "esriFieldTypeInteger"),
    ("o_orderstatus", "esriFieldTypeString"), ("o_totalprice", "esriFieldTypeDouble"),
    ("o_orderdate", "esriFieldTypeDate"),
)
PAGE_ROWS = 100


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as service pages: a hundred rows per page, a thousand per collection."""
    attributes = F.struct(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("o_orderdate"),
    )
    page = F.floor(F.col("o_orderkey") / PAGE_ROWS)
    feature = F.struct(attributes.alias("attributes"))
    in_collection = (F.col("page") % 10) * PAGE_ROWS
    return (
        table(spark, sf_dir, "orders")
        .groupBy(page.alias("page"))
        .agg(F.sort_array(F.collect_list(feature)).alias("features"))  # PAGE_ROWS entries at most
        .select(
            F.floor(F.col("page") / 10).alias("collection"),
            in_collection.alias("page_offset"),
            F.to_json(
                F.struct(F.col("features"), (F.col("page") % 10 < 9).alias("exceededTransferLimit"))
            ).alias("body"),
        )
    )


@query(
    "paged_ingest",
    """
    SELECT cast(o_orderkey AS INT) AS o_orderkey, cast(o_custkey AS INT) AS o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate
    FROM orders
    """,
)
def paged_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.page_rows(order_pages(spark, sf_dir), ORDER_FIELDS)
    return rows.withColumn("o_orderdate", C.iso_utc(F.col("o_orderdate")))


@query(
    "page_completeness",
    """
    WITH p AS (SELECT o_orderkey // 1000 AS collection, (o_orderkey % 1000) // 100 AS page, count(*) AS n
               FROM orders GROUP BY 1, 2),
         landed AS (SELECT *, (page = 9 AND collection % 4 <> 2) AS is_last FROM p
                    WHERE NOT (collection % 4 = 1 AND page = 3)),
         starts AS (SELECT collection, page * 100 + n AS page_end FROM landed)
    SELECT collection, count(*) AS pages, cast(sum(n) AS BIGINT) AS row_count,
           count(*) FILTER (WHERE is_last) AS last_pages,
           count(*) FILTER (WHERE page > 0 AND (collection, page * 100) NOT IN (SELECT collection, page_end FROM starts))
             AS gaps,
           count(*) FILTER (WHERE is_last) = 1
           AND count(*) FILTER (WHERE page > 0
               AND (collection, page * 100) NOT IN (SELECT collection, page_end FROM starts)) = 0
           AND count(*) FILTER (WHERE page = 0) = 1 AS complete
    FROM landed GROUP BY collection
    """,
)
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection in four lost a page, another one lacks its last-page mark."""
    pages = order_pages(spark, sf_dir).where("not (collection % 4 = 1 and page_offset = 300)")
    more = F.replace("body", F.lit('"exceededTransferLimit":false'), F.lit('"exceededTransferLimit":true'))
    pages = pages.withColumn("body", F.when(F.col("collection") % 4 == 2, more).otherwise(F.col("body")))
    return P.page_completeness(pages)


@query(
    "collection_versions",
    """
    WITH d AS (SELECT cast(user_id AS VARCHAR) AS collection, cast(ts AS DATE) AS day, count(*) AS row_count,
                      cast(sum(event_id) AS BIGINT) AS file_size
               FROM events GROUP BY 1, 2),
         r AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY day DESC) = 1 AS newest FROM d)
    SELECT collection, cast(day AS VARCHAR) AS version, cast(day AS VARCHAR) || 'T07:00:00Z' AS created,
           CASE WHEN day_of_month % 3 = 0 THEN NULL ELSE cast(day AS VARCHAR) || 'T01:00:00Z' END AS source_updated,
           row_count, file_size, CASE WHEN newest THEN 'data' ELSE 'archive' END AS role
    FROM (SELECT *, day(day) AS day_of_month FROM r)
    """,
)
def collection_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection documents are built from the event days, then read back as version records."""
    day = F.to_date("ts")
    days = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("id"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("size")
    )
    newest = days.groupBy("id").agg(F.max("day").alias("newest"))
    text = F.col("day").cast("string")
    asset = F.struct(
        text.alias("version"), F.concat(text, F.lit("T07:00:00Z")).alias("created"),
        F.when(F.dayofmonth("day") % 3 != 0, F.concat(text, F.lit("T01:00:00Z"))).alias("geo:source_updated"),
        F.col("rows").alias("table:row_count"), F.col("size").alias("file:size"),
    )
    key = F.when(F.col("day") == F.col("newest"), F.col("id")).otherwise(F.concat(F.lit("version-"), text))
    # one entry per day of the table's month
    assets = F.map_from_entries(F.collect_list(F.struct(key.alias("key"), asset.alias("value"))))
    docs = (
        days.join(newest, "id")
        .groupBy("id")
        .agg(assets.alias("assets"))
        .select("id", F.to_json(F.struct("id", "assets")).alias("text"))
    )
    versions = D.collection_versions(D.collection_documents(docs.withColumnRenamed("id", "path"), "geo"), "geo")
    return versions.select(
        "collection", "version", C.iso_utc(F.col("created")).alias("created"),
        C.iso_utc(F.col("source_updated")).alias("source_updated"), "row_count", "file_size", "role",
    )


@query(
    "style_rules",
    """
    WITH b AS (SELECT p_brand AS style, list_sort(list_distinct(list(p_size))) AS sizes FROM part GROUP BY p_brand)
    SELECT style, 0 AS rule_no, 'match' AS kind, 'p_size' AS "column", cast(len(sizes) + 1 AS INT) AS labels,
           0 AS stops, cast(list_sum(sizes) AS DOUBLE) AS label_sum FROM b
    UNION ALL SELECT style, 1, 'step', 'p_retailprice', 0, 2, NULL FROM b
    """,
)
def style_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One style document per brand: a grouped label list, a text label, and a nested step."""
    sizes = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.sort_array(F.collect_set("p_size")).alias("sizes"))
    paint = (
        '{"layers":[{"paint":{"fill-color":["match",["get","p_size"],%s,"#a","other","#b","#ccc"],'
        '"fill-opacity":["case",["has","x"],["step",["get","p_retailprice"],0.1,950,0.5,1000.5,0.9],'
        '["step",["zoom"],0.1,5,0.9]]}}]}'
    )
    docs = sizes.select(F.col("p_brand").alias("style"), F.format_string(paint, F.to_json("sizes")).alias("text"))
    rules = D.style_rules(docs)
    return rules.select(
        "style", "rule_no", "kind", "column", F.size("labels").alias("labels"), F.size("stops").alias("stops"),
        F.when(
            F.col("kind") == "match",
            F.aggregate("labels", F.lit(0.0), lambda acc, l: acc + F.coalesce(l["num"], F.lit(0.0))),
        ).alias("label_sum"),
    )


@query(
    "legend_drift",
    """
    WITH new AS (SELECT CASE WHEN c_custkey % 97 = 0 THEN 'ROBOTICS' WHEN c_mktsegment = 'MACHINERY' THEN 'BUILDING'
                             ELSE c_mktsegment END AS seg, c_nationkey, c_acctbal FROM customer),
         old AS (SELECT c_mktsegment AS seg, CASE WHEN c_nationkey = 7 THEN 8 ELSE c_nationkey END AS c_nationkey
                 FROM customer)
    SELECT 'a.json' AS style, 0 AS rule_no, 'match' AS kind, 'seg' AS "column", 'empty_branch' AS finding,
           'branch ''MACHINERY'' matches no row' AS detail, cast(NULL AS BIGINT) AS n
    WHERE NOT EXISTS (SELECT 1 FROM new WHERE seg = 'MACHINERY')
    UNION ALL
    SELECT 'a.json', 0, 'match', 'seg', 'new_value', 'new value ''' || seg || ''' has no branch', count(*)
    FROM new WHERE seg NOT IN ('MACHINERY', 'BUILDING') AND seg NOT IN (SELECT seg FROM old) GROUP BY seg
    UNION ALL
    SELECT 'b.json', 0, 'match', 'c_nationkey', 'new_value', 'new value ' || c_nationkey || ' has no branch', count(*)
    FROM new WHERE c_nationkey NOT IN (1, 2, 3) AND c_nationkey NOT IN (SELECT c_nationkey FROM old)
    GROUP BY c_nationkey
    UNION ALL
    SELECT 'b.json', 1, 'step', 'c_acctbal', 'empty_class', 'class [1000000.0, inf) holds no row', NULL
    WHERE NOT EXISTS (SELECT 1 FROM new WHERE c_acctbal >= 1000000)
    UNION ALL
    SELECT 'c.json', 0, 'match', 'c_phone', 'column_gone', 'the column is gone from the new data', NULL
    """,
)
def legend_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new version loses a segment and gains one; the old one had no nation 7."""
    customer = table(spark, sf_dir, "customer")
    segment = "CASE WHEN c_custkey % 97 = 0 THEN 'ROBOTICS' WHEN c_mktsegment = 'MACHINERY' THEN 'BUILDING' ELSE c_mktsegment END"
    new = customer.select(F.expr(segment).alias("seg"), "c_nationkey", "c_acctbal")
    moved = F.when(F.col("c_nationkey") == 7, 8).otherwise(F.col("c_nationkey"))
    old = customer.select(F.col("c_mktsegment").alias("seg"), moved.alias("c_nationkey"))
    rules = spark.createDataFrame(
        [
            ("a.json", 0, "match", "seg", [(None, "MACHINERY"), (None, "BUILDING")], []),
            ("b.json", 0, "match", "c_nationkey", [(1.0, None), (2.0, None), (3.0, None)], []),
            ("b.json", 1, "step", "c_acctbal", [], [0.0, 5000.0, 1000000.0]),
            ("c.json", 0, "match", "c_phone", [(1.0, None)], []),
        ],
        legend.RULES_SCHEMA,
    )
    return legend.legend_drift(rules, new, old)
