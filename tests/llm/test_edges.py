"""Nulls, empty and long texts, repeated rows, empty tables, and extra columns with names the operators use inside."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plotkeep.llm import (
    bitpack, chat, decontaminate, line_templates, merkle, packing, quality_crf, simhash, superminhash, url_templates,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy string, score double, n int, dropped string"
LONG = "word " * 60_000 + "end"
ROWS = [
    (1, "one two three four five six", "en", "s", 27, "c", 0.5, 1, "d"),
    (1, "one two three four five six", "en", "s", 27, "c", 0.5, 1, "d"),
    (2, None, None, None, None, None, None, None, None),
    (3, "", "en", "s", 0, "c", 0.5, 1, "d"),
    (4, LONG, "en", "s", len(LONG), "c", 0.5, 1, "d"),
    (None, "no id at all\nsecond line", "en", "s", 24, "c", 0.5, 1, "d"),
    (5, "\n \n\t", "en", "s", 4, "c", 0.5, 1, "d"),
    (6, "x" * 50_000, "en", "s", 50_000, "c", 0.5, 1, "d"),
]
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "Two, THREE"), (2, None), (None, "one"), (3, "!!")], "item_id long, text string")


def test_simhash(docs, none):
    got = {(r.doc_id, r.n_chars): r for r in simhash.with_edits(docs, 3).collect()}
    assert simhash.with_edits(docs, 3).count() == len(ROWS)
    assert got[2, 0].fp == got[3, 0].fp == 0
    assert simhash.with_edits(none, 3).count() == 0


def test_decontaminate(docs, none, items):
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r["items"]) for r in decontaminate.contamination(docs, items).collect()))
    assert got[0] == (0, 6, 0, 0, [])
    assert got[1] == got[2] == (1, 6, 2, 1, ["1"])
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2
    cut = decontaminate.without_spans(docs, items)
    assert cut.columns == docs.columns and cut.where("doc_id = 1").first().text == "one   four five six"
    assert cut.where("doc_id = 4").first().text == LONG


def test_large_benchmarks_are_joined_with_equal_results(spark, docs, none, monkeypatch):
    words = " ".join(f"w{i % 40}" for i in range(200))
    more = spark.createDataFrame([(7, words), (7, words), (7, "other"), (None, words), (8, "Two three!")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(more)
    items = spark.createDataFrame(
        [("a", "two three"), ("b", "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), ("c", "one two three four five"), ("d", None), ("e", "end")],
        "item_id string, text string")
    sent = sorted(map(repr, decontaminate.contamination(rows, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(repr, decontaminate.contamination(rows, items).collect())) == sent and len(sent) == len(ROWS) + 5
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.clean_documents(docs, items).columns == docs.columns


def test_line_templates(docs, none):
    out = line_templates.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert line_templates.dedup_lines(none).count() == 0


def test_near_duplicates(docs, none):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in superminhash.near_duplicates(docs).collect())
    assert got[:5] == [(0, 2, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert superminhash.one_of_each_group(docs).columns == docs.columns
    assert superminhash.near_duplicates(none).count() == 0


def test_tokens_and_packing(docs, none):
    read = bitpack.read_images(bitpack.write_images(docs, WORDS, 1, 3))
    assert read.count() == len(ROWS) and read.where("doc_id = 3").first().n_tokens == 1
    assert bitpack.read_images(bitpack.write_images(none, WORDS, 1, 3)).count() == 0
    pieces = packing.packed(docs, BYTES, 0)
    assert pieces.where("doc_id = 2").count() == 1
    assert pieces.agg(F.sum("length")).first()[0] == pieces.groupBy("doc_id", "doc_tokens").agg(
        F.count_if(F.col("start") == 0).alias("n")).agg(F.sum(F.col("doc_tokens") * F.col("n"))).first()[0]
    assert packing.packed(none, BYTES, 0).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (6, 0, 1), (None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    field = quality_crf.train(docs, labels)
    scored = quality_crf.score(docs.drop("score"), field)
    assert scored.count() == len(ROWS) and scored.where("score between 0 and 1").count() == len(ROWS)
    assert scored.where("doc_id = 2").first().score == scored.where("doc_id = 3").first().score
    assert quality_crf.accepted(docs, field).columns == docs.columns
    with pytest.raises(ValueError, match="score"):
        quality_crf.score(docs, field)
    neutral = quality_crf.train(none, labels.limit(0))
    assert {r.score for r in quality_crf.score(docs.drop("score"), neutral).collect()} == {0.5}


def test_merkle(spark):
    pages = spark.createDataFrame(
        [(1, "u", "a", "x"), (1, "u", "a", "x"), (None, None, None, "y"), (5000, "v", "", "z")],
        "page_id long, url string, html string, digest2 string")
    record = merkle.warc_record(F.col("url"), F.col("html"))
    laid = merkle.laid_out(pages, record).select("archive", "offset", "length", "digest")
    assert merkle.audit(laid, laid).count() == 0
    lost = merkle.audit(laid, laid.where("archive <> 5")).collect()
    assert [(r.archive, r.damage) for r in lost] == [(5, "lost")]
    assert [r.damage for r in merkle.audit(laid.limit(0), laid.where("archive = 5")).collect()] == ["added"]
    assert merkle.audit(laid.limit(0), laid.limit(0)).count() == 0


def test_urls(spark):
    rows = [(1, None, None), (2, "no scheme", None), (3, "HTTP://A.Example.COM?x", 1), (3, "HTTP://A.Example.COM?x", 1),
            (4, "s://net/", None), (5, "s://x.net#/", 0), (6, "s://notnet/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, label int")
    rules = [("block", "net", "/"), ("allow", "x.net", "/a/")]
    got = sorted((r.page_id, r.host, r.path, r.rule) for r in url_templates.judged(pages, rules).collect())
    assert got == [(1, "", "", None), (2, "", "", None), (3, "a.example.com", "", None), (3, "a.example.com", "", None),
                   (4, "net", "/", "net/"), (5, "x.net", "", None), (6, "notnet", "/", None)]
    assert url_templates.judged(pages.limit(0), rules).count() == 0


def test_chat(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", "a\\b#<</turn>\n### x: "), (1, 1, "assistant", "again"), (None, None, "a:b", "t")]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(said)).collect()}
    assert got[1].n_turns == 3 and got[1].loss_chars == len(rows[1][3]) + 5 and got[None].n_turns == 1
    assert chat.read_back(chat.formatted(said.limit(0))).count() == 0


def test_chat_finds_templates_that_rewrite_history():
    def forgets(turns):
        return "".join(f"<{r}>{t if k + 1 == len(turns) else '...'}" for k, (r, t) in enumerate(turns))

    text, spans, rewritten = chat.locate([("user", "hi"), ("assistant", "yo")], forgets)
    assert (text, spans, rewritten) == ("<user>...<assistant>yo", [], 1)
    text, spans, rewritten = chat.locate([("user", "hi"), ("assistant", "yo")], chat.marked_turns)
    assert rewritten is None and [text[s[1]:s[2]] for s in spans] == ["hi", "yo"]


def test_stages_with_clashing_columns(docs, items):
    names = ("_gone", "gone", "Score", "SCORE_", "_row", "_Copy", "held", "place")
    odd = docs.select("doc_id", "text", *[F.lit("x").alias(name) for name in names])
    assert superminhash.one_of_each_group(odd).columns == odd.columns
    assert line_templates.dedup_lines(odd).count() == len(ROWS)
    assert quality_crf.accepted(odd, quality_crf.neutral_field(), 0.0).columns == odd.columns
    assert decontaminate.clean_documents(odd, items).count() == len(ROWS) - 2


@pytest.mark.parametrize("rows", [ROWS, []], ids=["odd rows", "no rows"])
def test_pipeline(spark, items, tmp_path, rows):
    sf = str(tmp_path)
    names = ("_gone", "Score", "_row", "digest", "Head", "name0", "fixed")
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "lang", *[F.lit("x").alias(name) for name in names])
    docs.write.parquet(f"{sf}/documents.parquet")
    items.write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(4, 1), (6, 1), (None, 0)], "doc_id long, quality int").write.parquet(f"{sf}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.read.parquet(f"{sf}/documents.parquet").transform(lambda d, stage=stage: stage(spark, d, sf))
        assert out.columns == docs.columns, name
        assert out.exceptAll(docs).count() == 0, name
    pieces = corpus_pipeline.run(spark, sf)
    # each document is packed whole, and the one that holds benchmark words is not there
    whole = pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("ids"), F.count_if(F.col("start") == 0).alias("n"))
    assert whole.where(F.col("ids") != F.col("doc_tokens") * F.col("n")).count() == 0
    assert {r.doc_id for r in whole.collect()} <= {2, 3, 4, 5, 6, None}
