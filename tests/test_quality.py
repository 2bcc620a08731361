import pytest
from pyspark.sql import Observation

from millrace.operators.quality import (
    DROP,
    FAIL,
    Rule,
    apply_rules,
    expect_all,
    flow_metrics,
    quarantine,
    row_count_gate,
    rule_metrics,
)


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0), (None, 4.0)], "id INT, v DOUBLE")


RULES = [Rule("has_id", "id IS NOT NULL", DROP), Rule("positive", "v > 0")]


def test_warn_keeps_drop_removes_and_both_are_counted(df, rows):
    seen = Observation()
    kept = apply_rules(df, RULES, seen)
    assert rows(kept, "id") == [(1,), (2,), (3,)]
    assert seen.get == {"input_records": 4, "output_records": 3, "failed_0": 1, "failed_1": 2}


def test_null_predicate_is_a_violation(df, rows):
    assert rows(apply_rules(df, [Rule("positive", "v > 0", DROP)]), "id") == [(1,), (None,)]


def test_fail_stops_the_job_with_the_rule_name(df):
    with pytest.raises(Exception, match="positive"):
        apply_rules(df, [Rule("positive", "v > 0", FAIL)]).collect()
    assert apply_rules(df, [Rule("any", "true", FAIL)]).count() == 4


def test_a_dropped_row_still_breaks_a_fail_rule(df):
    rules = [Rule("positive", "v > 0", DROP), Rule("not_three", "id <> 3", FAIL)]
    with pytest.raises(Exception, match="not_three"):
        apply_rules(df.where("id IS NOT NULL"), rules).collect()


def test_metrics_rows(df, rows):
    assert rows(rule_metrics(df, RULES, "d")) == [("d", "has_id", 3, 1), ("d", "positive", 2, 2)]


def test_dropped_counts_rows_once(df, rows):
    rules = expect_all({"has_id": "id IS NOT NULL", "big": "v > 4"}, DROP)
    assert rows(flow_metrics(df, rules, "d")) == [("d", 1, 3, 3.0)]


def test_failure_rate_without_output_is_null(df, rows):
    assert rows(flow_metrics(df, [Rule("never", "false", DROP)], "d")) == [("d", 0, 4, None)]


def test_quarantine_names_every_broken_rule(df, rows):
    good, bad = quarantine(df, RULES)
    assert rows(good, "id") == [(1,)]
    assert rows(bad, "id", "failed_rules") == [
        (2, ["positive"]), (3, ["positive"]), (None, ["has_id"]),
    ]


def test_gate(df, rows):
    assert rows(row_count_gate(df, "GREATER_THAN", 3)) == [(4, True)]
    assert rows(row_count_gate(df.where("false"), "EQUAL_TO", 0)) == [(0, True)]


def test_unknown_action():
    with pytest.raises(ValueError):
        Rule("x", "true", "ignore")


def test_rules_on_an_empty_frame(df, rows):
    assert rows(rule_metrics(df.where("false"), RULES, "d")) == [
        ("d", "has_id", 0, 0), ("d", "positive", 0, 0),
    ]
