"""Benchmark decontamination by normalised n-grams, in built-in functions only.

The windows of all benchmark items form a hash set that is sent to every task.
A document's words are generated in place; the first words of a window are
looked up first, then the whole window's hash, and a match is confirmed on the
words themselves. Only confirmed matches are shuffled.

The benchmark is counted before it is sent; one with more windows than
``BROADCAST_WINDOWS`` is joined by a shuffle on the same hashes instead.

Cases: null and empty texts have no words and no hits; items without words have
no windows; items that repeat an id count once for it, and a null item id is
left out; equal rows of documents are counted together and each gets its row;
an empty benchmark hits nothing; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
BROADCAST_WINDOWS = 1_000_000

# What parts words: ASCII without 0-9 and a-z, once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; plain ASCII takes the built-in's fast way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN), "")


def _gram(words: Column, start: Column, n: int) -> Column:
    """Hash of the ``n`` words from a place (from 0); words past the end hash as nothing."""
    return F.xxhash64(F.lit(n), *[F.get(words, start + k) for k in range(n)])


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(n, gram, text, items) of every distinct window: its words, and the items that have it."""
    words = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(window))
    at = words.select("item", "words", n.alias("n"), F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("start"))
    cut = at.select("item", "n", F.slice("words", F.col("start") + 1, F.col("n")).alias("words"))
    return cut.groupBy("n", "words").agg(F.collect_set("item").alias("items"))


def _by_row(found: DataFrame) -> DataFrame:
    """Markers (n = 0) and matches, per distinct row."""
    return found.groupBy("doc_id", "copy").agg(
        F.max("size").cast("long").alias("n_words"),
        F.count_if(F.col("n") == 0).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("n") > 0, F.struct("start", "n")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def _shuffled_matches(rows: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, copy, size, start, n, items) for benchmarks too large to send around: a marker row per row, and the matches.

    Places travel as hashes; words move once, and only those of texts that have a match to confirm.
    """
    gram = F.coalesce(*[F.when(F.col("n") == n, _gram(F.col("words"), F.lit(0), n)) for n in lengths])
    known = windows.select("n", gram.alias("gram"), F.array_join("words", " ").alias("wanted"), "items")
    tries = F.flatten(F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array(*[
        F.struct(i.alias("start"), F.lit(n).alias("n"), _gram(F.col("words"), i, n).alias("gram")) for n in lengths])))
    at = rows.where(F.size("words") > 0).select("doc_id", "copy", F.inline(tries))
    near = at.join(known, ["n", "gram"]).drop("gram").distinct()

    def same(a: DataFrame, b: DataFrame) -> Column:
        return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["copy"] == b["copy"])

    of = near.select("doc_id", "copy").distinct()
    texts = rows.join(of, same(rows, of), "left_semi").groupBy("doc_id", "copy").agg(F.first("words").alias("words"))
    found = near.join(texts, same(near, texts)).where(F.array_join(F.slice("words", F.col("start") + 1, F.col("n")), " ") == F.col("wanted"))
    found = found.select(near["doc_id"], near["copy"], F.size("words").alias("size"), "start", "n", "items")
    return found.union(rows.select(
        "doc_id", "copy", F.size("words").alias("size"), F.lit(-1).alias("start"), F.lit(0).alias("n"),
        F.array().cast("array<string>").alias("items")))


def document_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, copy, copies, n_words, spans, items): per distinct row its confirmed windows as (start, words)."""
    windows = benchmark_windows(items, window)
    sizes = windows.groupBy("n").count().collect()  # at most ``window`` rows
    lengths = sorted(r.n for r in sizes)
    rows = docs.select("doc_id", F.xxhash64("text").alias("copy"), words_of(F.col("text")).alias("words"))
    if sum(r["count"] for r in sizes) > BROADCAST_WINDOWS:
        return _by_row(_shuffled_matches(rows, windows, lengths))
    lead = min([2, *lengths])

    # every document has one row that matches (place -1), so that its word count arrives too
    sentinel = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("gram"))
    known = windows.select("n", F.when(F.lit(True), F.array(*[F.get("words", F.lit(k)) for k in range(window)])).alias("w"), "words", "items")
    by_size = [F.when(F.col("n") == n, _gram(F.col("w"), F.lit(0), n)) for n in lengths]
    gram = F.coalesce(*by_size) if by_size else F.lit(0).cast("long")
    known = known.select("n", gram.alias("gram"), F.array_join("words", " ").alias("wanted"), "items",
                         _gram(F.col("w"), F.lit(0), lead).alias("head"))
    spark = docs.sparkSession
    none = spark.range(1).select(
        F.lit(0).alias("n"), F.lit(0).cast("long").alias("gram"), F.lit("").alias("wanted"),
        F.array().cast("array<string>").alias("items"), F.lit(0).cast("long").alias("head"))
    known = known.union(none)
    heads = known.select("head").distinct()

    at = rows.select("doc_id", "copy", "words", F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("place", "word"))
    at = at.withColumn("start", F.col("place") - 1).withColumn(
        "head", F.when(F.col("place") == 0, F.lit(0).cast("long")).otherwise(_gram(F.col("words"), F.col("start"), lead)))
    at = at.join(F.broadcast(heads), "head", "left_semi")
    grams = F.array(*[F.struct(F.lit(n).alias("n"), _gram(F.col("words"), F.col("start"), n).alias("gram")) for n in lengths])
    tries = F.when(F.col("place") == 0, F.array(sentinel)).otherwise(grams if lengths else F.array(sentinel))
    at = at.select("doc_id", "copy", "words", "start", F.explode(tries).alias("t")).select(
        "doc_id", "copy", "words", "start", F.col("t.n").alias("n"), F.col("t.gram").alias("gram"))
    found = at.join(F.broadcast(known.drop("head")), ["n", "gram"]).where(
        (F.col("n") == 0) | (F.array_join(F.slice("words", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("n")), " ") == F.col("wanted"))
    )
    return _by_row(found.select("doc_id", "copy", F.size("words").alias("size"), "start", "n", "items"))


def covered(spans: Column) -> Column:
    """Number of words inside any of the sorted (start, n) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        spans, zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(acc["end"], s["start"]))).alias("n"),
            F.greatest(acc["end"], s["start"] + s["n"]).alias("end"),
        ),
    )["n"].cast("long")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, n_hit, n_items, items (sorted), contaminated."""
    hits = document_hits(docs, items, window)
    return hits.select("doc_id", "n_words", covered(F.col("spans")).alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"), "items",
                       F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items", (F.col("n_hit") > 0).alias("contaminated"))


def _matched(docs: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    hits = hits.withColumnsRenamed({"doc_id": "_hit_id", "copy": "_hit_copy"})
    same = docs["doc_id"].eqNullSafe(hits["_hit_id"]) & (F.xxhash64(docs["text"]) == hits["_hit_copy"])
    return docs.join(hits, same, how)


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` that hold no window of the benchmark, with the columns they came with."""
    hit = document_hits(docs, items, window).where(F.size("spans") > 0).select("doc_id", "copy")
    return _matched(docs, hit, "left_anti")


def without_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words taken out of ``text``; what stands between words stays."""
    hit = document_hits(docs, items, window).where(F.size("spans") > 0).select("doc_id", "copy", F.col("spans").alias("_spans"))
    inner = docs.select(F.col("doc_id"), F.col("text"), F.struct("*").alias("_row"))
    both = _matched(inner, hit, "left")
    any_case = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = F.array_remove(F.split("text", any_case), "")
    gaps = F.split("text", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    gone = F.flatten(F.transform("_spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    both = both.select("_row", "_spans", F.col("text").alias("_text"), gone.alias("_gone"), words.alias("_words"), gaps.alias("_gaps"))
    rebuilt = F.array_join(F.transform(
        "_gaps", lambda gap, i: F.concat(gap, F.when(F.array_contains("_gone", i), F.lit("")).otherwise(F.coalesce(F.get("_words", i), F.lit(""))))), "")
    text = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(rebuilt)
    return both.select(*[(text if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])
