import json
import math

import pytest

from plotkeep.operators.legend import RULES_SCHEMA, legend_drift
from plotkeep.sources.documents import style_rules

STREETS = {"layers": [{"paint": {
    "line-color": ["match", ["get", "grade"], [10, 20], "#114477", 30, "#774411", "#888888"],
    "line-width": ["step", ["get", "width"], 1, 2.5, 4],
}}]}


@pytest.fixture(scope="module")
def rules(spark):
    docs = spark.createDataFrame([("streets.json", json.dumps(STREETS))], "style string, text string")
    return style_rules(docs)


def data(spark, grade, width):
    if grade is None:
        return spark.createDataFrame([(w,) for w in width], "width double")
    return spark.createDataFrame(list(zip(grade, width)), "grade long, width double")


def findings(rules, new, old=None):
    return sorted((r.finding, r.detail) for r in legend_drift(rules, new, old).collect())


BEFORE = ([20, 30, 10, 80, 80], [1.5, 4.0, 2.0, 7.25, 0.0])


@pytest.mark.parametrize("grade,width,expected", [
    ([30, 10, 80, 20], [6.0, 0.25, 2.5, 1.0], []),
    ([20, 80, 80, 10], [3.0, 1.0, 9.5, 2.0], [("empty_branch", "branch 30 matches no row")]),
    ([10, 20, 30], [0.5, 2.25, 1.0], [("empty_class", "class [2.5, inf) holds no row")]),
    ([55, 30, 20, 10], [2.0, 8.0, 0.5, 3.5], [("new_value", "new value 55 has no branch")]),
    (None, [4.5, 1.0], [("column_gone", "the column is gone from the new data")]),
    ([None, 30, 20, 10], [0.75, None, 3.0, 2.0], []),
    ([30, 20, 10], [math.inf, 2.0, math.nan], [("empty_class", "class [2.5, inf) holds no row")]),
    ([10, 20, 30], [2.5, -math.inf, 2.75], []),
])
def test_findings(spark, rules, grade, width, expected):
    assert findings(rules, data(spark, grade, width), data(spark, *BEFORE)) == expected


def test_without_previous_no_new_values(spark, rules):
    assert findings(rules, data(spark, [55, 30, 20, 10], [2.0, 8.0, 0.5, 3.5])) == []


def test_text_one_is_not_number_one(spark):
    rules = spark.createDataFrame([("s", 0, "match", "d", [(1.0, None), (None, "2")], [])], RULES_SCHEMA)
    text = spark.createDataFrame([("1",), ("2",)], "d string")
    assert findings(rules, text, text.where("d = '2'")) == [
        ("empty_branch", "branch 1 matches no row"), ("new_value", "new value '1' has no branch")]


def test_rule_extraction(spark, rows):
    doc = {"layers": [
        {"filter": ["==", ["get", "kind"], 1], "paint": {"fill-color": [
            "case", ["has", "a"], ["match", ["get", "a"], ["x", "y"], "#1", "z", "#2", "#0"],
            ["interpolate", ["linear"], ["zoom"], 5, ["step", ["get", "b"], "#1", 10, "#2", 20.5, "#3"]]]}},
        {"layout": {"visibility": "visible", "text-field": ["step", ["zoom"], "", 12, ["get", "name"]]}},
        {"paint": {"w": ["match", ["get", "n"], True, 1, 0, 2, 3]}},
    ]}
    docs = spark.createDataFrame([("s.json", json.dumps(doc)), ("empty.json", "{}")], "style string, text string")
    got = [(r.rule_no, r.kind, r.column, [tuple(v) for v in r.labels], r.stops)
           for r in style_rules(docs).orderBy("rule_no").collect()]
    assert got == [
        (0, "match", "a", [(None, "x"), (None, "y"), (None, "z")], []),
        (1, "step", "b", [], [10.0, 20.5]),
        (2, "match", "n", [(1.0, None), (0.0, None)], []),
    ]


def test_a_nested_column_is_found_by_its_own_name(spark, rules):
    flat = data(spark, [55, 30, 20], [2.0, 8.0, 0.5])
    nested = flat.selectExpr("named_struct('inner', named_struct('grade', grade)) AS outer", "width")
    assert findings(rules, nested) == findings(rules, flat) != []
    before = data(spark, *BEFORE)
    assert findings(rules, nested, before) == findings(rules, flat, before)
    assert findings(rules, flat, nested) == findings(rules, flat, flat)
    shadowed = flat.selectExpr("named_struct('grade', -1L) AS first", "grade", "width")
    assert findings(rules, shadowed) == findings(rules, flat)
