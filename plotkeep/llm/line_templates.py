"""Line dedup by a log-template tree.

Lines are parsed into a tree of fixed depth: the number of tokens, then the
leading tokens, in which fields with digits are wildcards. Within a leaf, a
position where no token leads is a wildcard as well; lines that agree with the
leaf's constant positions share its template, others keep their own text as
template. A template that recurs across documents is dropped from all of them.

Whole copies of a document are another stage's work and must not be hollowed
out here, so recurrence asks for different surroundings: a line that comes
along with the text around it is part of a copy. A line reaches the documents
that have it, or its leading tokens beside a neighbour's; edits seldom reach
both. Neighbouring lines that reach more than about half of a line's documents
are its passage; what precedes and follows the passage is told by the leading
tokens of the next line outside it. Where more than two thirds of a document's
lines reach so far, it is a copy and has no surroundings. A template is dropped if it stands in ``MIN_DOCS`` documents or more,
documents times tokens of the passage reach ``MIN_EVIDENCE`` in most of them, and no surrounding line goes with
it in more than half of its votes, or none on one side in half of them. Equal
surroundings are one vote, however many documents have them, and so are all
copies together.

Cases: null and empty texts have no lines and stay as they are; blank lines are
kept and are nobody's neighbour; a text that is one passage has no surroundings
and is left to document dedup; repeated rows (same id and text) count as one document
and are treated alike; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotkeep.llm.scratch import kept

DEPTH = 3
MIN_DOCS = 2
MIN_EVIDENCE = 40
# A leaf is generalised from so many different lines on, if this share of its positions is constant.
MIN_VARIANTS = 4
CONSTANT = 0.6
AGREE = 0.8
# A document is a copy if more than this share of its lines goes with a line.
WHOLE = 2 / 3
# Numbers of documents up to twice this are halved exactly.
EXACT = 8
# Stands for both surroundings of a line in copies.
COPIES = 0
# Leaves and templates up to this number are sent to all tasks; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000

WILDCARD = "<*>"
# A token with a digit, matched from its first character and without backtracking.
FIELD = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"


def line_tokens(line: Column) -> Column:
    fields = F.split(F.regexp_replace(line, FIELD, WILDCARD), r"\s+")
    # most lines hold no digit and no white space but blanks, and need no pattern
    return F.array_remove(F.when(line.rlike(r"[0-9\t\x0B\f\r]"), fields).otherwise(F.split(line, " ")), "")


def _text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def let(value: Column, fn) -> Column:
    """Bind a value for a lambda's body, where it would be computed for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _leading(tokens: Column) -> Column:
    return F.array(*[F.get(tokens, F.lit(i)) for i in range(DEPTH)])


def _leaf(tokens: Column) -> Column:
    return F.xxhash64(F.size(tokens), _leading(tokens))


def _line(tokens: Column) -> Column:
    return F.xxhash64(tokens)


def line_rows(docs: DataFrame) -> DataFrame:
    """One short row per line that is not blank: its document, place, tokens, and hashes of its leaf, lead and self."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("copy"), F.posexplode(_text_lines(F.col("text"))).alias("no", "text"))
    parsed = lines.select("doc_id", "copy", "no", line_tokens(F.col("text")).alias("tokens"))
    tokens = F.col("tokens")
    return parsed.where(F.size(tokens) > 0).select(
        "doc_id", "copy", "no", F.size(tokens).alias("n"), _leaf(tokens).alias("leaf"),
        F.xxhash64(_leading(tokens)).alias("lead"), _line(tokens).alias("line"))


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if counted as small; else left to a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def leaf_templates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(line, template) of lines that share a generalised template of their leaf."""
    variants = lines.where(F.col("n") > DEPTH).select("leaf", "line", "n").distinct()
    leaves = kept(
        variants.groupBy("leaf").agg(F.count("*").alias("variants")).where(F.col("variants") >= MIN_VARIANTS),
        "leaves",
    )
    # each different line is read from one place; few documents hold one
    places = (
        lines.where(F.col("n") > DEPTH).join(sized(leaves), "leaf", "left_semi")
        .groupBy("leaf", "line").agg(F.min(F.struct("doc_id", "copy", "no")).alias("place"))
        .groupBy(F.col("place.doc_id").alias("_id"), F.col("place.copy").alias("_copy"))
        .agg(F.collect_list(F.struct("leaf", "line", F.col("place.no").alias("no"))).alias("held"))
    )
    places = kept(places, "places")
    texts = docs.select("doc_id", F.xxhash64("text").alias("copy"), "text")
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    # two numbers a row go to the texts, so that only the texts that hold a place are shuffled
    texts = texts.join(sized(places.select("_id", "_copy")), here, "left_semi").join(places, here)
    own = let(_text_lines(F.col("text")), lambda all_lines: F.transform(
        "held", lambda h: F.struct(h.leaf.alias("leaf"), h.line.alias("line"), F.get(all_lines, h.no).alias("text"))))
    tokens = texts.select(F.inline(own)).select("leaf", "line", line_tokens(F.col("text")).alias("tokens"))
    in_leaf = tokens.select("leaf", "line", F.posexplode("tokens").alias("pos", "token"))
    cells = kept(
        in_leaf.select("leaf", "line", "pos", F.xxhash64("token").alias("token")).distinct(), "cells"
    )
    by_token = cells.groupBy("leaf", "pos", "token").agg(F.count("*").alias("times"))
    top = by_token.groupBy("leaf", "pos").agg(
        F.max(F.struct("times", "token")).alias("top"), F.sum("times").alias("all")
    ).select("leaf", "pos", F.col("top.token").alias("constant"), (F.col("top.times") * 2 > F.col("all")).alias("fixed"))
    shape = top.groupBy("leaf").agg(
        F.count("*").alias("n"), F.count_if("fixed").alias("fixed_n")
    ).where((F.col("fixed_n") >= CONSTANT * F.col("n")) & (F.col("fixed_n") < F.col("n")))
    fixed = top.where("fixed").join(shape, "leaf").select("leaf", "pos", "constant", "fixed_n")
    agree = (
        cells.join(sized(kept(fixed, "fixed")), ["leaf", "pos"])
        .groupBy("leaf", "line")
        .agg(F.count_if(F.col("token") == F.col("constant")).alias("same"), F.first("fixed_n").alias("fixed_n"))
        .where(F.col("same") >= AGREE * F.col("fixed_n"))
    )
    return agree.select("line", F.xxhash64(F.col("leaf"), F.lit("template")).alias("template"))


def _half(docs: Column) -> Column:
    """Half of ``docs``: exact for small numbers, else rounded up to a power of the square root of two."""
    half = F.floor(docs / 2)
    step = F.ceil(F.log2(half) * 2 - 1e-9)
    return F.when(half <= EXACT, half).otherwise(F.ceil(F.pow(F.lit(2.0), step / 2) - 1e-9)).cast("long")


def _reaching(lines: DataFrame) -> DataFrame:
    """Lines of documents with a recurring line, and ``reach``: the documents that have the line, or its and a neighbour's lead.

    Edited lines of copies seldom lose their leads, so they reach as far as the lines beside them.
    """
    doc = Window.partitionBy("doc_id", "copy")
    order = doc.orderBy("no")
    lines = lines.withColumns({
        "most": F.max("docs").over(doc),
        "last": F.xxhash64(F.lag("lead").over(order), "lead"), "next": F.xxhash64("lead", F.lead("lead").over(order))})
    lines = kept(lines.where(F.col("most") >= MIN_DOCS).drop("most"), "neighbours")
    pairs = (
        lines.select(F.col("last").alias("pair"), "doc_id", "copy").distinct()
        .groupBy("pair").agg(F.count("*").alias("met")).where(F.col("met") >= MIN_DOCS)
    )
    pairs = sized(kept(pairs, "pairs"))
    for name in ("last", "next"):
        lines = lines.join(pairs.select(F.col("pair").alias(name), F.col("met").alias(f"{name}_met")), name, "left").drop(name)
    return lines.withColumn("reach", F.greatest("docs", "last_met", "next_met")).drop("last_met", "next_met")


def _surroundings(lines: DataFrame, halves: list[int]) -> DataFrame:
    """Lines with the leads of the nearest lines outside their passage, its ``tokens``, and ``common``: what most of the document reaches.

    Outside are the lines that reach at most ``half`` documents. ``halves`` are all values of ``half``.
    """
    doc = Window.partitionBy("doc_id", "copy")
    # tokens up to each line's end, and so up to where a passage begins and ends
    lines = lines.withColumn("end", F.sum("n").over(doc.orderBy("no").rowsBetween(Window.unboundedPreceding, 0)))
    lines = lines.withColumn("size", F.sum("n").over(doc))
    place = F.lit(0).cast("int")
    for k, half in enumerate(halves):
        place = F.when(F.col("half") == half, F.lit(k)).otherwise(place)
    line = F.struct("no", "lead", "n", "end")
    sides = (("before", F.col("no").asc()), ("after", F.col("no").desc()))
    past = {name: doc.orderBy(order).rowsBetween(Window.unboundedPreceding, -1) for name, order in sides}
    # all but a third of the lines reach so many documents
    lines = lines.withColumn("common", F.percentile("reach", F.lit(1 - WHOLE)).over(doc))
    # a line that reaches no other document is outside of every passage; the rest is looked through for each half
    for name, _ in sides:
        lines = lines.withColumn(f"own_{name}", F.last(F.when(F.col("reach") == 1, line), ignorenulls=True).over(past[name]))
    lines = lines.where(F.col("reach") > 1)
    for name, _ in sides:
        nearest = [F.last(F.when(F.col("reach") <= half, line), ignorenulls=True).over(past[name]) for half in halves]
        # nothing recurs where there are no halves
        lines = lines.withColumn(name, F.get(F.array(*nearest), place) if nearest else F.when(F.lit(False), line))
        own, found = F.col(f"own_{name}"), F.col(name)
        nearer = found["no"] > own["no"] if name == "before" else found["no"] < own["no"]
        lines = lines.withColumn(name, F.when(own.isNull() | nearer, found).otherwise(own)).drop(f"own_{name}")
    begin = F.coalesce("before.end", F.lit(0))
    tokens = F.coalesce(F.col("after.end") - F.col("after.n"), "size") - begin
    return lines.withColumns({"tokens": tokens, "before": F.col("before.lead"), "after": F.col("after.lead")})


def recurring(lines: DataFrame) -> DataFrame:
    """Templates that recur across documents in different surroundings. ``lines`` has a ``template`` per row."""
    spread = (
        lines.select("template", "doc_id", "copy").distinct()
        .groupBy("template").agg(F.count("*").alias("docs"))
        .where(F.col("docs") >= MIN_DOCS)
        .withColumn("half", _half(F.col("docs")))
    )
    # written first: a join beyond the broadcast's size then reads both sides from shuffles, and hot templates are split
    spread = kept(spread, "spread")
    halves = sorted(r.half for r in spread.select("half").distinct().collect())  # a few dozen numbers
    counted = lines.join(sized(spread), "template", "left").withColumn("docs", F.coalesce("docs", F.lit(1)))
    enough = (F.col("docs") >= MIN_DOCS) & (F.col("docs") * F.col("tokens") >= MIN_EVIDENCE)
    around = _surroundings(_reaching(counted), halves).where(enough)
    # Most of the document comes along: a copy, of which edited lines are no surroundings. All copies have one vote, or
    # none if most of the document goes with the line everywhere and the text is the passage itself.
    whole, itself = F.col("common") > F.col("half"), F.col("common") >= F.col("docs")
    copies = F.when(~itself, F.lit(COPIES))
    around = around.withColumns({side: F.when(whole, copies).otherwise(F.col(side)) for side in ("before", "after")})
    per_doc = around.groupBy("template", "docs", "doc_id", "copy").agg(
        F.min("before").alias("before"), F.min("after").alias("after"))
    # equal surroundings are copies of one carrier and vote once
    votes = per_doc.groupBy("template", "docs", "before", "after").agg(F.count("*").alias("met"))
    vote = F.when(F.col("before").isNotNull() | F.col("after").isNotNull(), 1).otherwise(0)
    beside = votes.select("template", "docs", "met", vote.alias("vote"), F.explode(F.array(
        F.struct(F.lit(True).alias("before"), F.col("before").alias("lead")),
        F.struct(F.lit(False).alias("before"), F.col("after").alias("lead")))).alias("s"))
    known = F.col("lead").isNotNull()
    shares = (
        beside.groupBy("template", "docs", "s.before", "s.lead").agg(F.sum("vote").alias("times"), F.sum("met").alias("met"))
        .groupBy("template", "docs", "before").agg(
            F.max(F.when(known, F.col("times"))).alias("top"), F.sum(F.when(known, F.col("times"))).alias("known"),
            F.sum("times").alias("votes"), F.sum("met").alias("met"))
        # the passage has the evidence in most documents, not where it stands beside another one by chance
        .where(F.col("met") * 2 > F.col("docs"))
        # a side that most voters lack (the text begins or ends there) says nothing
        .where(F.col("known") * 2 >= F.col("votes"))
        .groupBy("template")
        .agg(F.max(F.col("top") / F.col("votes")).alias("strongest"), F.min(F.col("top") / F.col("votes")).alias("weakest"))
    )
    return shares.where((F.col("strongest") <= 0.5) | (F.col("weakest") < 0.5)).select("template")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, dropped): the places of recurring lines of each document that has any."""
    lines = kept(line_rows(docs), "lines")
    general = sized(kept(leaf_templates(docs, lines), "templates"))
    named = lines.join(general, "line", "left").withColumn("template", F.coalesce("template", "line"))
    found = sized(kept(recurring(named), "recurring"))
    return (
        named.join(found, "template", "left_semi")
        .groupBy("doc_id", "copy")
        .agg(F.collect_set("no").alias("dropped"))
    )


def without_recurring_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as ``_row``, with the cleaned ``text`` and the counts of lines and dropped lines."""
    hits = dropped_lines(docs)
    row = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_copy"), F.struct("*").alias("_row"))
    hits = hits.select(F.col("doc_id").alias("_hit_id"), F.col("copy").alias("_hit_copy"), "dropped")
    both = row.join(hits, F.col("_id").eqNullSafe(F.col("_hit_id")) & (F.col("_copy") == F.col("_hit_copy")), "left")
    lines = _text_lines(F.col("_row.text"))
    # array_except looks places up by hash
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "dropped")
    clean = let(lines, lambda all_lines: F.array_join(F.transform(places, lambda i: F.get(all_lines, i)), "\n"))
    return both.select(
        "_row",
        F.when(F.col("dropped").isNull(), F.col("_row.text")).otherwise(clean).alias("text"),
        F.when(F.coalesce(F.col("_row.text"), F.lit("")) == "", F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with recurring lines taken out; documents of which nothing is left go.

    Columns stay as they are, but for ``n_chars``, which follows the text where it exists.
    """
    done = without_recurring_lines(docs).where(
        (F.col("n_dropped") == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != "")
    )
    columns = []
    for name in docs.columns:
        column = F.col("text") if name == "text" else F.col("_row")[name]
        if name == "n_chars":
            column = F.when(F.col("n_dropped") > 0, F.char_length("text").cast(docs.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return done.select(*columns)
