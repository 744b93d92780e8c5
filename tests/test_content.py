import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plotkeep.functions.geometry import PARTS
from plotkeep.operators.content import advance_hash, changed_rows, content_hash, no_op_checks, version_diff

SCHEMA = "id int, name string, v double, tags array<int>, s struct<a:int,b:string>, m map<string,int>"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def digest(df, **kw):
    return content_hash(df, **kw).first().content_hash


def base_rows(n=60, seed=1):
    rnd = random.Random(seed)
    pick = lambda v: None if rnd.random() < 0.2 else v
    return [
        (i, pick(f"n{i % 7}"), pick(i / 3), pick([pick(i), 2, None]), pick((pick(i), pick("x"))), pick({"k": i, "l": 2}))
        for i in range(n)
    ]


@pytest.mark.parametrize("portable", [False, True])
def test_order_and_partitioning_do_not_matter(spark, portable):
    rows = base_rows()
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    drop = ["m"] if portable else []
    a = table(spark, rows).drop(*drop)
    b = table(spark, shuffled).repartition(3, "name").drop(*drop)
    assert digest(a, portable=portable) == digest(b, portable=portable)
    assert digest(a, portable=portable).endswith(":60")


@pytest.mark.parametrize("portable", [False, True])
def test_any_change_shows(spark, portable):
    schema = "a int, b int, t string, arr array<int>"
    rows = [(1, None, "x", [1, None]), (2, 3, "null", [2]), (2, 3, "null", [2])]

    def d(data):
        return digest(spark.createDataFrame(data, schema), portable=portable)

    whole = d(rows)
    variants = [
        rows[:2],                                        # a repeated row missing
        rows + [rows[1]],                                # one more copy
        [(None, 1, "x", [1, None])] + rows[1:],          # a null moved to the next column
        [(1, None, "x", [None, 1])] + rows[1:],          # a null moved inside an array
        [(1, None, "x", [1])] + rows[1:],                # a null dropped from an array
        [(1, None, None, [1, None])] + rows[1:],         # text to null
        [rows[0], (2, 3, None, [2]), rows[2]],           # the text 'null' is not a null
        [rows[0], (3, 2, "null", [2]), rows[2]],         # two values swapped
    ]
    assert whole not in [d(v) for v in variants]
    assert len({d(v) for v in variants}) == len(variants)


def test_text_encoding_has_no_ambiguous_separator(spark):
    a = spark.createDataFrame([("1:a", "b")], "x string, y string")
    b = spark.createDataFrame([("1", "a1:b")], "x string, y string")
    assert digest(a, portable=True) != digest(b, portable=True)


def test_empty_table(spark):
    assert digest(table(spark, [])) == "0:0"
    assert digest(table(spark, []).drop("m"), portable=True) == "0:0"


def test_odd_doubles(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,)], "v double")
    assert digest(df, portable=True).endswith(":4")


def test_groups(spark, rows):
    data = table(spark, base_rows())
    per_group = {r[0]: r[1] for r in rows(content_hash(data, by=["name"]).select("name", "content_hash"))}
    for name in ("n1", "n2"):
        only = content_hash(data.where(F.col("name") == name).drop("name")).first().content_hash
        assert per_group[name] == only


def test_geometry_is_canonicalised(spark):
    ring = [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 0.0)]
    turned = [(2.0, 0.0), (0.0, 0.0), (2.0, 1.0), (2.0, 0.0)]
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("parts", PARTS)])
    a = spark.createDataFrame([(1, [[ring]])], schema)
    b = spark.createDataFrame([(1, [[turned]])], schema)
    assert digest(a, parts="parts") == digest(b, parts="parts")
    assert digest(a) != digest(b)


def test_no_op(spark, rows):
    cur = spark.createDataFrame([("a", "1:1"), ("b", "2:2")], "collection string, content_hash string")
    new = spark.createDataFrame([("a", "1:1"), ("b", "3:2"), ("c", "0:0")], "collection string, content_hash string")
    got = {r[0]: r[3] for r in rows(no_op_checks(cur, new).select("collection", "current_hash", "extracted_hash", "no_op"))}
    assert got == {"a": True, "b": False, "c": False}


def test_version_diff_against_multisets(spark, rows):
    rnd = random.Random(5)
    old = [(rnd.randrange(40), rnd.randrange(3)) for _ in range(120)]
    new = [r for r in old if rnd.random() > 0.1] + [(rnd.randrange(50), rnd.randrange(3)) for _ in range(15)]

    def by_key(data):
        out = {}
        for k, v in data:
            out.setdefault(k, Counter())[v] += 1
        return out

    a, b = by_key(old), by_key(new)
    expected = sorted(
        (k, "added" if k not in a else "removed" if k not in b else "changed")
        for k in a.keys() | b.keys() if a.get(k) != b.get(k)
    )
    df = lambda data: spark.createDataFrame(data, "k int, v int")
    assert sorted(tuple(r) for r in version_diff(df(old), df(new), ["k"]).collect()) == expected


def test_hash_kept_up_by_differences(spark, rows):
    schema = "id long, name string, size double"
    old = [(i, f"n{i % 4}", i / 3) for i in range(40)] + [(7, "n3", 7 / 3)] * 2 + [(None, "n1", 0.5), (50, None, None)]
    changes = {
        "edit": [(i, n, -1.0 if i == 5 else s) for i, n, s in old],
        "remove": old[3:],
        "repeat": old + old[:4] + [old[-1]],
        "one copy less": old[:-3] + old[-2:],
        "null key": [r for r in old if r[0] is not None] + [(None, "n1", 0.75), (None, "n9", 1.0)],
        "one group gone": [r for r in old if r[1] != "n2"],
        "all gone": [],
        "same": old[::-1],
    }
    before = spark.createDataFrame(old, schema)
    for what, data in changes.items():
        after = spark.createDataFrame(data, schema)
        left, came = changed_rows(before, after, version_diff(before, after, ["id"]), ["id"])
        for by, portable in (([], False), (["name"], True)):
            kept_up = advance_hash(content_hash(before, by, portable=portable), left, came, by, portable=portable)
            assert rows(kept_up) == rows(content_hash(after, by, portable=portable)), (what, by)
        assert what != "same" or left.count() + came.count() == 0
    first = advance_hash(content_hash(before.limit(0)), before.limit(0), before)  # from an empty version
    assert rows(first) == rows(content_hash(before))


def test_a_hash_is_not_kept_up_over_other_columns(spark):
    one = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(ValueError):
        advance_hash(content_hash(one), one, one.withColumn("v", F.col("v").cast("long")))
