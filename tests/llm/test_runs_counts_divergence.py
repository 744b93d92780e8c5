"""Periodic runs, token counts and source divergence against brute force, and their edge cases."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plotkeep.llm import divergence, periodic_runs, recompression, token_counts
from plotkeep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_tokens int, term string, place int, start string, value int"
LONG = "word " * 60_000 + "end"
ROWS = [
    (1, "one two three four", "en", "s", 1, "t", 2, "x", 3),
    (1, "one two three four", "en", "s", 1, "t", 2, "x", 3),
    (2, None, None, None, None, None, None, None, None),
    (3, "", "en", "s", 1, "t", 2, "x", 3),
    (4, LONG, "en", "r", 1, "t", 2, "x", 3),
    (None, "no id\x0bat\x1call", "en", "q", 1, "t", 2, "x", 3),
    (5, "\n \n\t", "de", "s", 1, "t", 2, "x", 3),
    (6, "x" * 50_000, "de", "s", 1, "t", 2, "x", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def brute_runs(words):
    """Stretches with equal words p apart, for every p; of equal stretches the smallest p."""
    found = {}
    for p in range(1, len(words) // 3 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def run_row(words):
    runs = brute_runs(words)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    milli = None if not runs else math.floor(Fraction(1000 * best[1], best[2]))
    return (len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 4))
def test_extensions_agree_with_comparison(some, times):
    symbols = np.array(some * times, np.int64)
    grammar = recompression.Grammar(symbols)
    for of, whole in ((grammar, symbols), (grammar.mirrored(), symbols[::-1])):
        i, j = np.triu_indices(len(symbols) + 1, 1)
        plain = [next((k for k in range(len(whole)) if b + k >= len(whole) or whole[a + k] != whole[b + k]), 0) for a, b in zip(i, j)]
        assert of.extension(i, j).tolist() == plain


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 14)), max_size=5))
def test_runs_agree_with_brute_force(parts):
    words = [w for base, times in parts for w in base * times]
    runs = periodic_runs.runs_of(np.array([*words, 99], np.int64), len(words))
    assert list(zip(runs.start, runs.length, runs.period)) == brute_runs(words)


def test_runs_inside_runs():
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    for words in (fib[-1] * 3, "a" * 500, ("a" * 30 + "b") * 4, ("ab" * 15 + "c") * 5 + "ab" * 40):
        symbols = np.array([ord(c) for c in words] + [0], np.int64)
        runs = periodic_runs.runs_of(symbols, len(words))
        assert list(zip(runs.start, runs.length, runs.period)) == brute_runs(words)


def test_no_run_leaves_its_text():
    rows = list(periodic_runs.slice_rows([1, 2], ["a " * 23, "a " * 23], None))
    assert [r[1] for r in rows] == [0, 0]


@needs_tables
def test_op11(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs) and any(r[0] for r in got.values())
    for doc in docs:
        words = re.findall("[^\x20\x09-\x0d]+", doc.text or "")
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n <= 1500:
            assert got[doc.doc_id] == run_row(words), doc.doc_id


def test_runs_edges(docs):
    got = {(r.doc_id, r.collapsed): r for r in periodic_runs.periodic_runs(docs).collect()}
    assert periodic_runs.periodic_runs(docs).count() == len(ROWS)
    assert got[4, "word end"].length == 60_000 and got[4, "word end"].period == 1
    assert got[2, ""].n_runs == got[3, ""].n_runs == 0 and got[2, ""].start is None
    assert (None, "no id at\x1call") in got  # white space is ASCII's
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_pretokens_of_settled_characters_are_the_librarys():
    cutter = token_counts.Pretokenizer(BYTES)
    settled = re.compile(f"[{token_counts.SETTLED}]")
    for c in filter(settled.match, map(chr, range(0xD800))):
        text = f"a{c}a1{c}1!{c}! {c} {c}{c}"
        plain = [text[a:b] for _, (a, b) in cutter.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        assert [p for part in cutter.pretokens(text) for p in part] == plain, hex(ord(c))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("ab1'sStre .,_\n\t\r  \x85é²½Ⅷ日本، ۱𞤀😀") + ["<|endoftext|>", "'ll", "  "]), max_size=40).map("".join))
def test_counts_are_the_librarys(text):
    cutter = token_counts.pretokenizer(BYTES)
    for frequent in ({}, {"a": 1, " ": 1}):
        assert cutter.counts([text, text], frequent) == cutter.whole([text, text])


def test_counts_across_chunks_and_caches(monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    monkeypatch.setattr(token_counts, "CACHED", 5)
    monkeypatch.setattr(token_counts, "TOGETHER", 3)
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "bc", " ", "  ", "\n", "é", "!", "'s", "12"]) for _ in range(300)) for _ in range(30)]
    cutter = token_counts.Pretokenizer(BYTES)
    assert cutter.counts(texts, {}) == cutter.whole(texts) and len(cutter.cache) <= 5


@needs_tables
def test_op12(spark):
    tokenizer = Tokenizer.from_file(BYTES)
    got = {r.doc_id: r for r in QUERIES["op12_token_counts"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        n = len(tokenizer.encode(doc.text or "", add_special_tokens=False).ids)
        assert (got[doc.doc_id].n_tokens, got[doc.doc_id].over_limit) == (n, n > 512)
        assert got[doc.doc_id].n_bytes == len((doc.text or "").encode())


def test_counts_edges(docs):
    tokenizer = Tokenizer.from_file(BYTES)
    plain = sorted((r[0] or 0, len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.counted(docs, BYTES).collect()) == plain
    assert token_counts.counted(docs.limit(0), BYTES).count() == 0
    whole = token_counts.counted(docs, PIECES)  # a vocabulary without pre-tokens
    assert whole.where("doc_id = 3").first().n_tokens == 0 and whole.where("doc_id = 1").first().n_tokens > 3


def brute_divergence(rows):
    """(lang, source, part, item, value, rank) by the definition, over all kept terms of all pairs."""
    lower = str.maketrans(divergence.UPPER, divergence.LOWER)
    counts, docs, groups = {}, Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = re.findall(divergence.TERM, (text or "").translate(lower))
        counts.setdefault((lang, source), Counter()).update(words)
        docs.update((lang, w) for w in set(words))
    kept = {lang: [w for (of, w), n in docs.items() if of == lang and n >= 10] for lang, _ in groups}

    def shares(count, lang):
        total, v = sum(count[w] for w in kept[lang]), len(kept[lang])
        return {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * v) for w in kept[lang]}

    out = []
    for lang, source in groups:
        p = shares(counts[lang, source], lang)
        q = shares(sum((c for (of, _), c in counts.items() if of == lang), Counter()), lang)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = []
        for other in {s for of, s in groups if of == lang} - {source}:
            r = shares(counts[lang, other], lang)
            pairs.append((other, sum(f(p[w], r[w]) for w in kept[lang])))
        terms = [(w, f(p[w], q[w])) for w in kept[lang] if counts[lang, source][w] and p[w] > q[w]]
        for part, its, top in (("pair", pairs, None), ("term", terms, 10)):
            ranked = sorted(its, key=lambda x: (-x[1], x[0].encode()))[:top]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def test_divergence_agrees_with_the_definition(spark, docs):
    rng = random.Random(8)
    words = ["É", "a", "b", "c", "Dd", "ee", "Ünd", "日本"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["en", "de", None]), rng.choice(["p", "q", "r", "ß", None]))
            for _ in range(150)]
    rows += [("rare only", "xx", "p"), (None, "xx", "q"), ("a", "one", "alone")]
    got = divergence.divergence(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows)
    edges = sorted(map(tuple, divergence.divergence(docs).collect()))
    assert edges == brute_divergence([r[1:4] for r in ROWS])
    assert divergence.divergence(docs.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(1, 4), st.integers(3, 9), min_size=2), min_size=1, max_size=12))
def test_tree_agrees_with_all_pairs_of_rows(rows):
    zeros = {1: 2, 2: 1, 3: 5, 4: 4}
    f = lambda a, b: (a - b) ** 2 // (a + b)
    plain = Counter()
    for row in rows:
        for one in row:
            for two in row:
                if one < two:
                    p, q, p0, q0 = row[one], row[two], zeros[one], zeros[two]
                    plain["x", one, two] += f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    paths = sorted(Counter(tuple((s, n, zeros[s]) for s, n in sorted(row.items())) for row in rows).items())
    starts = np.cumsum([0] + [len(p) for p, _ in paths])
    nodes = tuple(np.array([node[i] for p, _ in paths for node in p], np.int64) for i in range(3))
    got = Counter()
    for _, one, two, value in divergence.tree_sums(np.zeros(len(paths), np.int64), starts, nodes, np.array([n for _, n in paths])):
        for key in zip(one.tolist(), two.tolist(), value.tolist()):
            got["x", key[0], key[1]] += key[2]
    assert got == plain


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F

    cases = [(0, 0, 1), (10**15 + 7, 3 * 10**16 + 1, 10**8), (10**17, 10**17, 5), (1, 10**18 - 3, 1)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    got = [r.p for r in df.select(divergence.scaled_share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in cases]
