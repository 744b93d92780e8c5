"""Near-duplicate documents: SuperMinHash signatures, banding, verification, components.

Every shingle visits the slots of the signature in an order of its own; what
it offers on its j-th visit lies in [j, j+1), so a slot filled in round j never
changes in a later one and a set is done as soon as all slots are filled. The
ranks of one shingle in two slots differ, which lowers the variance below that
of independent hashes. The orders are the lines ``a + j*b`` modulo the prime
``SLOTS``: like random orders, they give any two slots each pair of different
ranks equally often, and they need no state per shingle.

Sets that are equal (copies) are one class. Sets of up to ``SMALL`` shingles
also have bands of single shingles, the first of each in the order of their
hashes: small similar sets always share one of these. Classes that share a band are linked to one of them, the hub, after comparing whole
sets, and, where a band still holds several components, to its most central
class, whose shingles are the most frequent: in a group of copies of one text
with edits, that is the one with the fewest edits, to which nearly all that have
a link at all have one. Where a band holds several components even then, its classes are
joined by their rarest shingles (similar sets share one early enough), so no
link between different components is lost; inside a component no more pairs
are needed. The join makes a pair only if the parity bits of the two sets differ in no
more places than similar sets may, so edits of one text that are too far apart make few
rows of it, though it compares them. No step pairs a linked group with itself.

Cases: a text without words (null, empty, white space) is linked with nothing;
fewer words than a shingle make one shingle of them all; equal rows
share a group and their fate, and a row that repeats a doc_id with another text
has the group of its own text and is kept or not by itself; rows with a null doc_id are linked with nothing and kept; extra
columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotkeep.llm.components import components
from plotkeep.llm.scratch import kept
from plotkeep.llm.text import U64, WHITE, mix, slices, word_hashes

SHINGLE = 5
SLOTS = 127
BAND = 4
BANDS = SLOTS // BAND
# Links are sets with 100 * intersection >= PERCENT * union.
PERCENT = 75
# Words of 64 parity bits of a set.
PARITY = 8
# Signatures of smaller sets vary too much to be trusted alone.
SMALL = 16
# Sizes of sets whose ratio is below this are one class.
SIZE_RATIO = 1.05

_SPREAD = mix(np.arange(11, 11 + 64, dtype=U64)) | U64(1)


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and their bounds."""
    hashes, owner = word_hashes([t.encode("utf-8", "replace") for t in texts], WHITE)
    words = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(words) - words
    length = np.minimum(words, SHINGLE)
    # the start of a shingle has enough words of its text behind it
    starts = np.flatnonzero(np.arange(len(hashes)) + length[owner] <= (first + words)[owner]) if len(hashes) else np.empty(0, int)
    value = np.zeros(len(starts), U64)
    padded = np.concatenate([hashes, np.zeros(SHINGLE, U64)])
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            part = padded[starts + k] * _SPREAD[k]
            value += np.where(k < length[owner[starts]], part, U64(0))
        value += length[owner[starts]].astype(U64) * _SPREAD[SHINGLE]
    value, at = mix(value), owner[starts]
    order = np.lexsort((value, at))
    value, at = value[order], at[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1])
    value, at = value[new], at[new]
    return value, np.searchsorted(at, np.arange(len(texts) + 1))


def signatures(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SuperMinHash of each set: [set, SLOTS], all ones where a set is empty."""
    sets = len(bounds) - 1
    size = np.diff(bounds)
    empty = U64(0xFFFFFFFFFFFFFFFF)
    out = np.full(sets * SLOTS, empty)
    at = np.repeat(np.arange(sets), size)
    origin = (mix(value ^ _SPREAD[20]) % U64(SLOTS)).astype(np.int64)
    stride = (mix(value ^ _SPREAD[21]) % U64(SLOTS - 1)).astype(np.int64) + 1
    seed = value
    for visit in range(SLOTS):
        if not len(seed):
            break
        offer = (U64(visit) << U64(56)) | (mix(seed ^ _SPREAD[22] ^ mix(np.array([visit], U64))) >> U64(8))
        np.minimum.at(out, at * SLOTS + origin, offer)
        origin = (origin + stride) % SLOTS
        open_sets = (out.reshape(sets, SLOTS) == empty).any(axis=1)
        going = open_sets[at]
        seed, at, origin, stride = seed[going], at[going], origin[going], stride[going]
    return out.reshape(sets, SLOTS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """[set, BANDS] hashes of BAND consecutive slots and of the band's place."""
    rows = signature[:, : BANDS * BAND].reshape(len(signature), BANDS, BAND)
    keys = np.zeros(rows.shape[:2], U64)
    with np.errstate(over="ignore"):
        for k in range(BAND):
            keys += mix(rows[:, :, k]) * _SPREAD[30 + k]
        keys += np.arange(BANDS, dtype=U64)[None, :] * _SPREAD[35]  # equal slots of different bands do not meet
    return mix(keys)


def _set_name(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each whole set, [set, 2]."""
    out = np.zeros((len(bounds) - 1, 2), U64)
    with np.errstate(over="ignore"):
        for k in range(2):
            sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(value ^ _SPREAD[40 + k]))])
            out[:, k] = mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(U64))
    return out


def _parity_bits(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """[set, PARITY] words: each shingle turns one bit of its set, so two sets differ in as many shingles as bits, or more."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = mix(value ^ _SPREAD[50]) % U64(64 * PARITY)
    out = np.zeros((len(bounds) - 1) * PARITY, U64)
    np.bitwise_xor.at(out, owner * PARITY + (place // U64(64)).astype(np.int64), U64(1) << place % U64(64))
    return out.reshape(-1, PARITY)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64), pa.int64()))


def _small_keys(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners of the first shingles of small sets: all but those that a similar set may lack, and one more."""
    size = np.diff(bounds)
    owner = np.repeat(np.arange(len(size)), size)
    first = np.where(size <= SMALL, size - -(-size * PERCENT // 100) + 1, 0)
    taken = np.arange(len(value)) - bounds[owner] < first[owner]
    return mix(value[taken] ^ _SPREAD[45]), owner[taken]


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n, name0, name1, bands) of every row: the text's digest, set size, the set's name, band keys.

    An empty set has no band keys.
    """
    def run(batches):
        for batch, texts in slices(batches, "text"):
            value, bounds = shingle_sets(texts)
            size = np.diff(bounds)
            names = _set_name(value, bounds)
            keys = band_keys(signatures(value, bounds))[size > 0]
            small, of = _small_keys(value, bounds)
            owner = np.concatenate([np.repeat(np.flatnonzero(size > 0), BANDS), of])
            order = np.argsort(owner, kind="stable")
            ends = np.searchsorted(owner[order], np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("digest"), pa.array(size, pa.int64()),
                 pa.array(names[:, 0].view(np.int64)), pa.array(names[:, 1].view(np.int64)),
                 _lists(np.concatenate([keys.ravel(), small])[order], ends)],
                ["doc_id", "digest", "n", "name0", "name1", "bands"],
            )

    return docs.select("doc_id", "text", F.md5("text").alias("digest")).mapInArrow(
        run, "doc_id long, digest string, n long, name0 long, name1 long, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """(id, name0, name1, shingles, bits) of the given rows."""
    words = [f"w{k}" for k in range(PARITY)]

    def run(batches):
        for batch, texts in slices(batches, "text"):
            value, bounds = shingle_sets(texts)
            names = _set_name(value, bounds).view(np.int64)
            parity = np.ascontiguousarray(_parity_bits(value, bounds).T).view(np.int64)
            bits = pa.StructArray.from_arrays([pa.array(word) for word in parity], words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names[:, 0]), pa.array(names[:, 1]), _lists(value, bounds), bits],
                ["id", "name0", "name1", "shingles", "bits"])

    return docs.select("id", "text").mapInArrow(
        run, f"id long, name0 long, name1 long, shingles array<long>, bits struct<{', '.join(f'{w}: long' for w in words)}>")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("one"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("two"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("one", "two")))
    union = F.size("one") + F.size("two") - F.col("common")
    return both.where(F.col("common") * 100 >= union * PERCENT).select("a", "b")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, id, n, component) of bands that hold more than one component."""
    named = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return named.join(several.select("key"), "key", "left_semi")


def _size_fits(one, two):
    return (F.least(one, two) * 100 >= F.greatest(one, two) * PERCENT)


def _size_class(n):
    return F.floor(F.log(n) / F.log(F.lit(SIZE_RATIO)))


def _bits_fit(one, two, n, m):
    """As similar sets differ in ``(n + m) * (100 - PERCENT) / (100 + PERCENT)`` shingles at most."""
    apart = sum((F.bit_count(one[f"w{k}"].bitwiseXOR(two[f"w{k}"])) for k in range(PARITY)), F.lit(0))
    return apart * (100 + PERCENT) <= (n + m) * (100 - PERCENT)


def _ordered(ids: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, n, bits, alone, order, central) of the sets ``ids``: how many shingles no other of them has, and the rest, rare first.

    ``central`` is the greater, the more frequent all its shingles are.
    """
    cells = sets.join(ids, "id").select("id", F.explode("shingles").alias("shingle"))
    spread = cells.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    order = cells.join(spread, "shingle").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("times", "shingle"))).alias("order"), F.sum(F.log("times")).alias("logs"))
    n = F.size("shingles").cast("long")
    # those that share no shingle are linked with none
    return sets.join(order, "id").select(
        "id", n.alias("n"), "bits", (n - F.size("order")).alias("alone"), "order.shingle", (F.col("logs") / n).alias("central")
    ).withColumnRenamed("shingle", "order")


def _prefix_pairs(mixed: DataFrame, sets: DataFrame, ordered: DataFrame | None = None) -> DataFrame:
    """Pairs of different components that share one of their rarest shingles early enough.

    Sets of sizes n and m are similar from ``75 * (n + m) / 175`` common elements on. In
    any common order, here rare shingles first, the first common one is then at most that
    many places before the end of either. Every set lists its shingles up to that place for
    each class of partner sizes. In a list, members of its largest component meet only the
    others, so a group whose sets are linked already is not paired with itself. What two
    similar sets do not share is bounded as well, and so are the parity bits that differ.
    ``ordered`` is the order of at least these sets, if there is one already.
    """
    ids = mixed.select("id", "component").distinct()
    if ordered is None:
        ordered = _ordered(ids.select("id").distinct(), sets)
    n = F.col("n")
    least, most = F.ceil(n * PERCENT / 100), F.floor(n * 100 / PERCENT)
    head = F.slice("order", 1, F.greatest(n - least + 1 - F.col("alone"), F.lit(0)).cast("int"))
    listed = ordered.join(ids, "id").select(
        "id", "component", "n", "alone", least.alias("least"), most.alias("most"), F.posexplode(head).alias("at", "shingle"))
    listed = listed.select(
        "id", "component", "n", (F.col("alone") + F.col("at")).alias("place"), "shingle", "least",
        _size_class(n).alias("own"), F.explode(F.sequence(_size_class(least), _size_class(most))).alias("partner"))
    smallest = F.greatest(F.col("least"), F.floor(F.pow(F.lit(SIZE_RATIO), F.col("partner")) - 1e-6))
    listed = kept(listed.where((n - F.col("place")) * (100 + PERCENT) >= PERCENT * (n + smallest)).drop("least"), "listed")
    key = ["shingle", "lower", "upper"]
    listed = listed.withColumns({"lower": F.least("own", "partner"), "upper": F.greatest("own", "partner")})
    main = (
        listed.groupBy(*key, "component").agg(F.count("*").alias("members"))
        .groupBy(*key).agg(F.max_by("component", F.struct("members", "component")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1").drop("parts")
    )
    one = listed.join(main, key).join(ordered.select("id", "bits"), "id").select(
        *key, "main", F.col("id").alias("a"), "component", "n", "place", "own", "bits")
    two = one.where(F.col("component") != F.col("main")).select(
        *key, F.col("a").alias("b"), F.col("component").alias("component_b"), F.col("n").alias("m"),
        F.col("place").alias("place_b"), F.col("own").alias("own_b"), F.col("bits").alias("bits_b"))
    common = F.least(n - F.col("place"), F.col("m") - F.col("place_b"))
    return (
        one.join(two, key)
        .where(
            (F.col("component") != F.col("component_b"))
            & ((F.col("component") == F.col("main")) | (F.col("a") < F.col("b")))
            # each lists the shingle for the other's class
            & (F.least("own", "own_b") == F.col("lower")) & (F.greatest("own", "own_b") == F.col("upper"))
            & _size_fits(n, F.col("m")) & (common * (100 + PERCENT) >= PERCENT * (n + F.col("m")))
            & _bits_fit(F.col("bits"), F.col("bits_b"), n, F.col("m"))
        )
        .select("a", "b").distinct()
    )


def _class_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, shingles, bits) of ``classes`` (id, first, name0, name1), read from one of the rows with the id ``first``."""
    key = ["first", "name0", "name1"]
    source = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    firsts = classes.select(F.col("first").alias("id")).distinct()
    # rows of one id may have several texts, or one text several times
    found = _sets(source.join(firsts, "id", "left_semi")).groupBy(F.col("id").alias("first"), "name0", "name1").agg(
        F.first(F.struct("shingles", "bits")).alias("set"))
    return found.join(classes.select("id", *key), key).select("id", "set.shingles", "set.bits")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n, name0, name1, head) of every row of ``docs`` (doc_id, text).

    ``head`` (first, name0, name1) is the smallest doc_id of the row's group and the set
    that stands for the group, null for a text without words or a row without a doc_id.
    """
    signs = kept(signed(docs), "signs")
    classes = kept(
        signs.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("name0", "name1", "n")
        .agg(F.min("doc_id").alias("first"), F.min_by("bands", "doc_id").alias("bands"))
        # a doc_id may have several texts, so it cannot name a class; written once, these ids stay
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    members = classes.select("id", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(
        F.count("*").alias("times"), F.min(F.struct("id", "n")).alias("hub")).where("times > 1")
    members = kept(members.join(shared.select("key", "hub"), "key"), "members")
    needed = members.select("id").distinct()
    sets = kept(_class_sets(docs, classes.join(needed, "id", "left_semi")), "sets")

    # the hub that most of a class's bands name
    pairs = (
        members.where((F.col("id") != F.col("hub.id")) & _size_fits(F.col("n"), F.col("hub.n")))
        .groupBy("id", F.col("hub.id").alias("b")).agg(F.count("*").alias("times"))
        .groupBy("id").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b"))
        .select(F.col("id").alias("a"), "b")
    )
    links = _similar(pairs, sets)
    members = members.drop("hub")
    links = kept(links, "similar")
    labels = kept(components(links), "labels")
    mixed = kept(_mixed(members, labels), "mixed")
    ordered = kept(_ordered(mixed.select("id").distinct(), sets), "ordered")
    hubs = mixed.join(ordered.select("id", "central"), "id").groupBy("key").agg(
        F.max_by(F.struct("id", "n", "component"), F.struct("central", "id")).alias("hub"))
    pairs = (
        mixed.join(hubs, "key")
        .where((F.col("component") != F.col("hub.component")) & _size_fits(F.col("n"), F.col("hub.n")))
        .select(F.col("id").alias("a"), F.col("hub.id").alias("b")).distinct()
    )
    links = kept(links.union(_similar(pairs, sets)), "similar")
    labels = kept(components(links), "labels")
    mixed = kept(_mixed(members, labels), "mixed")
    links = links.union(_similar(_prefix_pairs(mixed, sets, ordered), sets))
    labels = kept(components(links), "labels")

    own = F.struct("first", "name0", "name1")
    tied = classes.select("id", own.alias("own")).join(labels, "id")
    heads = tied.groupBy("component").agg(F.min("own").alias("head"))
    heads = tied.select("id", "component").join(heads, "component").select("id", "head")
    named = classes.join(heads, "id", "left").select("name0", "name1", "n", F.coalesce("head", own).alias("head"))
    return signs.drop("bands").join(named, ["name0", "name1", "n"], "left").select(
        "doc_id", "digest", "n", "name0", "name1", F.when(F.col("doc_id").isNotNull(), F.col("head")).alias("head"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    return (
        groups(docs)
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("head.first", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without those whose group is shown by another id or set. Equal rows share their fate."""
    shown = (F.col("doc_id") == F.col("head.first")) & (F.col("name0") == F.col("head.name0")) & (
        F.col("name1") == F.col("head.name1"))
    gone = groups(docs).where(~shown).select(F.col("doc_id").alias("gone"), "digest").distinct()
    # each side's column by its frame: ``docs`` may have one of the same name
    return docs.join(gone, (docs["doc_id"] == gone["gone"]) & (F.md5(docs["text"]) == gone["digest"]), "left_anti")
