"""The queries against brute force and SQL on the smallest tables, and the operators on planted cases."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plotkeep.llm import bitpack, components, line_templates, packing, quality_crf, simhash, superminhash, tokens, url_templates
from plotkeep.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return duck.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, ([r[c] for c in names] for r in df.collect()))) == sorted(map(str, map(list, cursor.fetchall())))


@needs_tables
def test_op1(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op1_simhash"](spark, SF).collect()}
    prints = {d: int(r.fingerprint, 16) for d, r in got.items()}
    for i, (doc, text) in enumerate(texts):
        following, after = texts[(i + 1) % len(texts)]
        k = len(text) // 4
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256((text[:len(text) - k] + after[:k]).encode()).hexdigest()
        assert got[doc].near_next == 1 - (prints[doc] ^ prints[following]).bit_count() / 64
        if doc % 100 == 0:
            assert got[doc].n_near == sum((prints[doc] ^ p).bit_count() <= simhash.RADIUS for p in prints.values())


def test_block_tables_miss_nothing(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in range(5)]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    prints = spark.createDataFrame([(signed(v), 2) for v in set(near)], "fp long, times long")
    got = {r.fp: r.near for r in simhash.near_counts(prints, prints.select("fp")).collect()}
    assert got == {signed(a): 2 * sum((a ^ b).bit_count() <= 3 for b in set(near)) for a in set(near)}


def test_near_pairs_name_the_prints_within_the_radius(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(63) for _ in range(20)]
    near = sorted({b ^ sum(1 << i for i in rng.sample(range(63), k)) for b in base for k in range(5)})
    prints = spark.createDataFrame([(v, 3) for v in near], "fp long, times long")
    got = [tuple(r) for r in simhash.near_pairs(prints, prints.select("fp").limit(60)).collect()]
    asked = {q for q, _, _ in got}
    assert len(asked) == 60 and len(got) == len(set(got))
    assert set(got) == {(a, b, 3) for a in asked for b in near if (a ^ b).bit_count() <= 3}


def word_sets(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(lower))
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
        yield doc, set(grams)


def groups(sets):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            one, two = find(a), find(b)
            root[max(one, two)] = min(one, two)
    return {d: find(d) for d in sets}


@needs_tables
def test_op6(spark, texts):
    sets = dict(word_sets(texts))
    expected = groups(sets)
    got = QUERIES["op6_near_duplicates"](spark, SF).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (d, len(s), expected[d], expected[d] == d) for d, s in sets.items()}


def test_chains_of_edits_stay_one_group(spark):
    """Copies that drift apart: ends of a chain are unlike, neighbours are alike."""
    rng = random.Random(1)
    words, rows = [f"w{i}" for i in range(80)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        for place in rng.sample(range(80), 1):
            words[place] = f"e{i}x{place}"
    rows += [(100 + i, " ".join(f"u{i}v{k}" if k % 3 == 0 else f"w{k}" for k in range(80))) for i in range(30)]
    expected = groups(dict(word_sets(rows)))
    got = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_prefix_pairs_find_what_the_hubs_have_not_linked(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        words = [f"w{k}" for k in range(100)]
        for place in rng.sample(range(100), rng.choice([1, 2, 3, 4, 5])):
            words[place] = f"x{i}y{place}"
        rows.append((i, " ".join(words)))
    ids = spark.createDataFrame([(i, i) for i, _ in rows], "id long, component long")
    source = spark.createDataFrame(rows, "id long, text string")
    sets = superminhash._sets(source)
    found = {tuple(sorted((r.a, r.b))) for r in superminhash._similar(superminhash._prefix_pairs(ids, sets), sets).collect()}
    exact = dict(word_sets(rows))
    assert found == {(a, b) for a, b in combinations(range(60), 2)
                     if 100 * len(exact[a] & exact[b]) >= 75 * len(exact[a] | exact[b])}


def test_edits_too_far_apart_make_no_pairs(spark, monkeypatch):
    """Many edits of one text, few of them alike: few of their pairs are left to confirm."""
    rng = random.Random(3)
    rows = []
    for i in range(150):
        words = [f"w{k}" for k in range(150)]
        for place in rng.sample(range(150), rng.choice([1, 3, 4, 5, 6])):
            words[place] = f"x{i}y{place}"
        rows.append((i, " ".join(words)))
    asked, similar = [], superminhash._similar

    def spy(pairs, sets):
        asked.append(pairs.count())
        return similar(pairs, sets)

    monkeypatch.setattr(superminhash, "_similar", spy)
    got = superminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == groups(dict(word_sets(rows)))
    assert asked[-1] <= len(rows), asked


def test_parity_bits_differ_in_no_more_places_than_the_sets():
    rng = random.Random(5)
    for size in (1, 20, 300, 3000):
        one = {rng.randrange(1 << 64) for _ in range(size)}
        two = {*rng.sample(sorted(one), size - size // 4), *(rng.randrange(1 << 64) for _ in range(size // 5))}
        value, ends = np.array([*sorted(one), *sorted(two)], np.uint64), np.cumsum([0, len(one), len(two), 0])
        bits = superminhash._parity_bits(value, ends)
        apart = sum((a ^ b).bit_count() for a, b in zip(bits[0].tolist(), bits[1].tolist()))
        assert apart <= len(one ^ two) and apart % 2 == len(one ^ two) % 2 and not bits[2].any()


def test_rows_of_one_id_keep_their_texts(spark):
    one, two = "a b c d e f g", "q r s t u v w"
    rows = [(0, one), (1, one), (1, two), (3, two), (4, one + " x"), (None, two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, superminhash.one_of_each_group(docs).collect()), key=repr) == [(0, one), (1, two), (None, two)]
    got = {(r.doc_id, r.component_id) for r in superminhash.near_duplicates(docs).collect()}
    assert got == {(0, 0), (1, 0), (1, 1), (3, 1), (4, 0), (None, None)}


def test_small_similar_sets_always_share_a_key():
    rng = random.Random(5)
    for _ in range(3000):
        size = rng.randint(1, superminhash.SMALL)
        one = rng.sample(range(10**6), size)
        two = [x for x in one if rng.random() < 0.9] + rng.sample(range(10**6, 2 * 10**6), rng.randint(0, 2))
        two = two[: superminhash.SMALL] or [1]
        value = np.array(sorted(set(one)) + sorted(set(two)), np.uint64)
        keys, owner = superminhash._small_keys(value, np.array([0, len(set(one)), len(value)]))
        common = len(set(one) & set(two))
        if 100 * common >= 75 * len(set(one) | set(two)):
            assert set(keys[owner == 0]) & set(keys[owner == 1])


def tree_of(urls):
    """Template of every path of one host by walking the tree of its segments."""
    found = {}

    def walk(members, level, prefix):
        for path in [p for p in members if len(p) <= level]:
            found[path] = prefix
        members = [p for p in members if len(p) > level]
        seen = Counter()
        for p in members:
            seen[p[level]] += urls[p]
        branches = defaultdict(list)
        for p in members:
            branches[p[level] if seen[p[level]] >= url_templates.SUPPORT else "*"].append(p)
        for segment, inside in branches.items():
            walk(inside, level + 1, f"{prefix}/{segment}")

    walk(list(urls), 0, "")
    return found


def test_path_templates_same_as_a_walk(spark):
    rng = random.Random(3)
    urls = Counter()
    for _ in range(1500):
        depth = rng.choice([0, 1, 2, 3, 6, 9])
        urls[tuple(rng.choice(["a", "b", f"s{rng.randrange(12)}", str(rng.randrange(10**6))]) for _ in range(depth))] += 1
    rows = [("h", "".join(f"/{s}" for s in p), n, 0, 0) for p, n in urls.items()] + [("i", "/a*b", 30, 0, 0)]
    paths = spark.createDataFrame(rows, "host string, path string, n long, labelled long, good long")
    got = {(r.host, r.path): r.template for r in url_templates.path_templates(paths).collect()}
    assert got == {("i", "/a*b"): "/a%2Ab"} | {
        ("h", "".join(f"/{s}" for s in p)): t for p, t in tree_of(urls).items()}


@pytest.mark.parametrize("sections", [5, 20, 60])
def test_one_bad_section_is_found_at_any_size_and_depth(spark, sections):
    rows = [(f"s://{host}/{start}s{k}/{n}", int(k > 0)) for k in range(sections) for n in range(100)
            for host, start in (("flat", ""), ("deep", "a/b/c/d/e/"))]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, label int")
    got = url_templates.judged(pages, []).select("host", "path", "verdict", "template", "purity").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.verdict == ("block" if "/s0/" in r.path else "allow")
        assert r.template.endswith("/s0/*") == ("/s0/" in r.path)
    if sections > 5:  # the good ones do not differ from what all have in common
        assert {r.template for r in got if "/s0/" not in r.path} == {"/?/*", "/a/b/c/d/e/?/*"}
        share = (sections - 1) * 100
        host = (share + 5 * (sections - 1) / sections) / (sections * 100 + 5)
        assert all(r.purity == pytest.approx((share + 5 * host) / (share + 5)) for r in got if "/s0/" not in r.path)


def test_alike_sections_merge_from_the_deepest_level_up(spark):
    rows = [(f"s://h/{a}/{b}/{n}", int(n % 4 > 0)) for a in "xyz" for b in "uvw" for n in range(40)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, label int")
    got = {(r.template, round(r.purity, 9)) for r in url_templates.judged(pages, []).collect()}
    assert len(got) == 1 and {t for t, _ in got} == {"/?/?/*"}


def test_superminhash_estimates_similarity():
    one = " ".join(f"a{i}" for i in range(400))
    two = " ".join(f"a{i}" if i < 320 else f"b{i}" for i in range(400))
    value, bounds = superminhash.shingle_sets([one, two])
    exact = len(set(value[:bounds[1]]) & set(value[bounds[1]:])) / len(set(value))
    signs = superminhash.signatures(value, bounds)
    assert abs((signs[0] == signs[1]).mean() - exact) < 0.15
    value, bounds = superminhash.shingle_sets(["single"])
    assert len(set(superminhash.signatures(value, bounds)[0] >> np.uint64(56))) == superminhash.SLOTS  # all ranks differ


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        one, two = find(a), find(b)
        root[max(one, two)] = min(one, two)
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.id: r.component for r in components.components(df).collect()}
    assert got == {x: find(x) for a, b in links for x in (a, b) if a != b}


def test_recurring_lines_go_and_copies_stay(spark):
    rng = random.Random(3)
    sentence = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage, block = sentence(60), [sentence(25), sentence(30), sentence(22)]
    rows = []
    for i in range(12):
        lines = [sentence(12) for _ in range(5)]
        if i < 4:
            lines.insert(2, passage)
        if 4 <= i < 9:
            lines[3:3] = block
        lines.insert(rng.randrange(6), f"Posted by editor on 2024-01-{i + 1:02d} at 1{i % 10}:00 in the daily news of our town")
        rows.append((i, "\n".join(lines)))
    whole = "\n".join(sentence(30) for _ in range(6))
    rows += [(100 + i, whole) for i in range(3)]
    edited = whole.split("\n")
    edited[3] = edited[3].replace(edited[3].split()[20], "changed")
    rows.append((200, "\n".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_templates.dedup_lines(docs).collect()}
    for i, text in rows[:12]:
        assert [x for x in text.split("\n") if x != passage and x not in block and "Posted" not in x] == got[i].split("\n")
    assert all(got[i] == text for i, text in rows[12:])


def _sentences(seed):
    rng = random.Random(seed)
    return lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


def _cleaned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.text for r in line_templates.dedup_lines(docs).collect()}


def test_passages_with_edited_lines_go_whole(spark):
    """Lines of one passage stand in different numbers of documents; a line between more frequent ones goes as well."""
    sentence = _sentences(11)
    passage, framed, header, footer = [sentence(25) for _ in range(3)], sentence(25), sentence(22), sentence(24)
    rows, expected = [], {}
    for i in range(40):
        own = [sentence(12) for _ in range(8)]
        middle = list(passage)
        if i < 6:
            edited = i % 3
            middle[edited] = middle[edited] + f" edit{sentence(1)}"
        # the last token keeps an edited line's lead: it stays, being one document's own
        rows.append((i, "\n".join(own[:4] + middle + own[4:])))
        expected[i] = "\n".join(own[:4] + [x for x in middle if x not in passage] + own[4:])
    for i in range(100, 130):
        own = [sentence(12) for _ in range(8)]
        block = [header, framed, footer] if i < 112 else [header, sentence(25), footer]
        rows.append((i, "\n".join(own[:3] + block + own[3:])))
        expected[i] = "\n".join(x for x in rows[-1][1].split("\n") if x not in (header, framed, footer))
    assert _cleaned(spark, rows) == expected


def test_edited_copies_are_not_hollowed(spark):
    """Copies with edits on different lines, some of which reach the leading tokens."""
    sentence = _sentences(12)
    base, rows = [sentence(25) for _ in range(20)], []
    for i in range(12):
        lines = list(base)
        for k in (i, (i * 7 + 3) % 20):
            words = lines[k].split()
            words[(i * 5) % 25] = f"e{sentence(1)}"
            lines[k] = " ".join(words)
        rows.append((i, "\n".join(lines)))
    assert _cleaned(spark, rows) == dict(rows)



def test_copies_of_a_carrier_do_not_outvote_the_others(spark):
    sentence = _sentences(13)
    many, few, rows, expected = sentence(30), sentence(30), [], {}

    def carriers(passage, copies):
        for times in copies:
            own = [sentence(12) for _ in range(6)]
            for _ in range(times):
                rows.append((len(rows), "\n".join(own[:3] + [passage] + own[3:])))
                expected[len(rows) - 1] = "\n".join(own)

    carriers(many, [60] + [1] * 10)
    carriers(few, [2, 1])
    assert _cleaned(spark, rows) == expected



@pytest.mark.parametrize("carriers", [2, 3])
def test_evidence_is_that_of_the_passage(spark, carriers):
    """Six lines of ten words; a short line that two documents share by chance stays."""
    sentence = _sentences(14)
    passage, chance, rows, expected = [sentence(10) for _ in range(6)], sentence(4), [], {}
    for i in range(carriers):
        own = [sentence(12) for _ in range(9)]
        if i < 2:
            own[1] = chance
        rows.append((i, "\n".join(own[:4] + passage + own[4:])))
        expected[i] = "\n".join(own)
    assert _cleaned(spark, rows) == expected


def test_packed_sequences_are_full():
    rng = random.Random(4)
    for lengths in ([1], [1024], [1025, 3], [rng.randrange(1, 5000) for _ in range(300)], [700] * 7, []):
        pieces = packing.pack(lengths)
        for doc, n in enumerate(lengths):
            at = 0
            for _, start, tokens_, _, _ in sorted(p for p in pieces if p[0] == doc):
                assert start == at
                at += tokens_
            assert at == n
        by_sequence = {}
        for _, _, n, sequence, offset in sorted(pieces, key=lambda p: (p[3], p[4])):
            assert offset == by_sequence.get(sequence, 0)
            by_sequence[sequence] = offset + n
        assert all(n <= 1024 and n & (n - 1) == 0 for n in by_sequence.values())
        assert sorted(by_sequence) == list(range(len(by_sequence)))


@needs_tables
def test_op5_and_op8(spark, texts):
    for name, vocabulary, end in (("op5_bitpack", "word_bpe_49k.json", 1), ("op8_cost_packing", "byte_bpe_50k.json", 0)):
        whole = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        ids = {d: np.array(whole.encode(t, add_special_tokens=False).ids + [end], "<u4") for d, t in texts}
        at, start = 0, {}
        for d, _ in texts:
            start[d], at = at, at + len(ids[d])
        for r in QUERIES[name](spark, SF).collect():
            if end:
                assert (r.start, r.n_tokens, r.ids_crc32) == (start[r.doc_id], len(ids[r.doc_id]), zlib.crc32(ids[r.doc_id].tobytes()))
            else:
                assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())


@pytest.mark.parametrize("width", [1, 5, 8, 15, 16, 17, 32])
def test_bit_packing_reads_any_run(width):
    rng = np.random.default_rng(width)
    ids = [rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 9000, 5)]
    image = bitpack.Image(bitpack.write_image([7, None, 8, 9], ids, width, 100))
    flat = np.concatenate(ids)
    for a, b in [(0, len(flat)), (4095, 4097), (8191, 8193), (17, 17), (9000, 9006)]:
        assert np.array_equal(image.read(a, b), flat[a:b])
    assert [(d, s, len(x)) for d, s, x in image.documents()] == [(7, 100, 0), (None, 100, 1), (8, 101, 9000), (9, 9101, 5)]


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(vocabulary):
    rng = random.Random(9)
    letters = "ab A.\n\n  é\t\u00a0\u3000ñ'st!3’\u0301\x1c漢<|endoftext|>\r😀Σ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    encoder = tokens.Encoder(public_tokenizers.path(vocabulary))
    assert all(np.array_equal(a, b) for a, b in zip(encoder.encode(texts), encoder.whole(texts)))


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_inside_texts_are_read_as_the_library_does(vocabulary):
    rng = random.Random(3)
    words = ["a", " b", "end", " of ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "\n"]
    texts = ["end <|endoftext|> of", "<|endoftext|>", ""]
    texts += ["".join(rng.choice(words) for _ in range(rng.randrange(9))) for _ in range(500)]
    plain = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [a.tolist() for a in tokens.Encoder(public_tokenizers.path(vocabulary)).encode(texts)] == expected


@needs_tables
def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op10_quality"](spark, sf).where("held_out")
    both = scored.join(spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in both]) > 0.93


def test_marginals_of_a_chain_against_all_labelings():
    rng = np.random.default_rng(0)
    score, ties = rng.normal(size=(1, 5, 2)), rng.normal(size=(2, 2))
    single, pair = quality_crf._marginals(score, ties, np.ones((1, 5), bool))
    weight, ones = 0.0, np.zeros(5)
    for code in range(32):
        labels = [code >> t & 1 for t in range(5)]
        w = np.exp(sum(score[0, t, y] for t, y in enumerate(labels)) + sum(ties[a, b] for a, b in zip(labels, labels[1:])))
        weight += w
        ones += w * np.array(labels)
    assert np.allclose(single[0, :, 1], ones / weight) and np.isclose(pair.sum(), 4)


@needs_tables
def test_pipeline_keeps_one_of_each_group_and_no_passage(spark, texts):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, SF)
    assert got.count() and {"doc_id", "ids", "sequence_id"} <= set(got.columns)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    hit = {r.doc_id for r in QUERIES["op2_decontaminate"](spark, SF).where("contaminated").collect()}
    assert not hit & {r.doc_id for r in got.select("doc_id").collect()}
    assert {r.doc_id for r in got.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
