import math

import pytest
from pyspark.sql import functions as F

from strata.functions.rules import (
    DEFAULT_RULES_PATH,
    any_violation,
    check_rules,
    load_rules,
    range_predicate,
    rule_predicates,
    violated_rules,
)
from strata.schemas import ID_FIELDS, METRIC_FIELDS


def test_rules_file_has_four_numeric_ranges(rules):
    ranges = rules["numeric_ranges"]
    assert set(ranges) == {"distance", "temperature", "amount", "duration"}
    for spec in ranges.values():
        assert isinstance(spec["min"], (int, float)) and isinstance(spec["max"], (int, float))
        assert spec["min"] <= spec["max"]


def test_rule_fields_are_leaf_fields(rules):
    check_rules(rules, ID_FIELDS + METRIC_FIELDS + ["note"])


def test_missing_rules_file_gives_empty(tmp_path):
    assert load_rules(tmp_path / "nope.yaml") == {}
    with pytest.raises(FileNotFoundError):
        load_rules(tmp_path / "nope.yaml", strict=True)


def test_bad_rules_are_rejected(tmp_path):
    with pytest.raises(ValueError):
        check_rules({"numeric_ranges": {"x": {"min": 5, "max": 1}}})
    with pytest.raises(ValueError):
        check_rules({"numeric_ranges": {"x": {"min": "0", "max": 1}}})
    with pytest.raises(ValueError):
        check_rules({"numeric_ranges": {"x": {"min": True, "max": 1}}})
    with pytest.raises(ValueError):
        check_rules({"numeric_ranges": {"x": {"min": 0, "max": 1}}}, ["y"])
    p = tmp_path / "r.yaml"
    p.write_text("numeric_ranges:\n  x: {min: 3, max: 2}\n")
    with pytest.raises(ValueError):
        load_rules(p)


def test_range_predicate_semantics(spark):
    rows = [(v,) for v in [-1.0, 0.0, 5.0, 10.0, 10.5, None, math.nan]]
    df = spark.createDataFrame(rows, "x double")
    out = df.select("x", range_predicate("x", 0, 10).alias("bad")).collect()
    got = {(None if r.x is None else ("nan" if math.isnan(r.x) else r.x)): r.bad for r in out}
    # bounds are valid, NULL never breaks a rule, NaN is above every number
    assert got == {-1.0: True, 0.0: False, 5.0: False, 10.0: False, 10.5: True, None: None, "nan": True}
    only_max = df.select(range_predicate("x", None, 10).alias("b")).filter("b").count()
    assert only_max == 2  # 10.5 and NaN
    assert df.select(range_predicate("x").alias("b")).filter("b").count() == 0


def test_rules_on_absent_fields_are_skipped(spark, rules):
    df = spark.createDataFrame([(1.0,)], "distance double")
    assert list(rule_predicates(rules, df.columns)) == ["distance"]


def test_violated_rules_lists_every_broken_rule(spark, rules):
    df = spark.createDataFrame([(-1.0, 20.0, 90000), (1.0, 20.0, 5)], "distance double, temperature double, duration int")
    preds = rule_predicates(rules, df.columns)
    out = df.select(violated_rules(preds).alias("v"), any_violation(preds).alias("a")).collect()
    assert [r.v for r in out] == [["distance", "duration"], []]
    assert [r.a for r in out] == [True, False]


def test_default_rules_path_exists():
    import os

    assert os.path.exists(DEFAULT_RULES_PATH)
    assert F is not None


def test_a_rule_on_an_unknown_field_can_be_refused(tmp_path):
    import pytest

    from strata.functions.rules import load_rules

    path = tmp_path / "rules.yaml"
    path.write_text("numeric_ranges:\n  amuont: {min: 0}\n")
    assert load_rules(path)
    with pytest.raises(ValueError, match="amuont"):
        load_rules(path, fields=["amount"])
