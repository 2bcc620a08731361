import pytest

from millrace.operators.sizing import hot_slots
from millrace.operators.merge import (
    ACTION,
    DuplicateMatch,
    delete_where,
    merge,
    merge_actions,
    update_where,
)

SCHEMA = "id LONG, price DOUBLE, note STRING"


@pytest.fixture()
def target(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a"), (2, 2.0, "b"), (3, None, "c"), (None, 9.0, "t")], SCHEMA
    )


def source(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_upsert_all_columns(spark, target, rows):
    new = source(spark, (2, 5.0, "B"), (4, 4.0, "d"))
    assert rows(merge(target, new, ["id"])) == sorted(
        [(1, 1.0, "a"), (2, 5.0, "B"), (3, None, "c"), (4, 4.0, "d"), (None, 9.0, "t")], key=repr
    )


def test_hot_target_key_gives_the_same_result(spark, rows):
    target = spark.range(900).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 WHEN id % 100 = 1 THEN NULL ELSE id END AS id",
        "CAST(id % 9 AS DOUBLE) AS price", "'t' AS note",
    )
    new = spark.range(0, 1200, 5).selectExpr("id", "4.0D AS price", "'s' AS note")
    hot = hot_slots(target, ["id"], rows_per_task=200)
    assert len(hot) == 1
    options = {"when": "s.price != t.price", "update": {"price": "s.price"},
               "not_matched_by_source_delete": True}
    plain = merge_actions(target, new, ["id"], hot=[], **options)
    assert rows(merge_actions(target, new, ["id"], hot=hot, **options)) == rows(plain)


def test_guard_is_not_null_safe_and_absent_rows_go(spark, target, rows):
    new = source(spark, (1, 1.0, "same"), (2, 8.0, "raised"), (3, 3.0, "was null"))
    result = merge(
        target, new, ["id"], when="s.price != t.price", update={"price": "s.price"},
        not_matched_by_source_delete=True,
    )
    assert rows(result) == [(1, 1.0, "a"), (2, 8.0, "b"), (3, None, "c")]


def test_null_keys_never_match(spark, target, rows):
    new = source(spark, (None, 7.0, "s"))
    tagged = merge_actions(target, new, ["id"])
    assert (None, 7.0, "insert") in rows(tagged, "id", "price", ACTION)
    assert (None, 9.0, "keep") in rows(tagged, "id", "price", ACTION)


def test_insert_list_computes_values(spark, target, rows):
    new = spark.createDataFrame([(2, 8.0), (7, 6.0), (None, 4.0)], "id LONG, raised DOUBLE")
    result = merge(
        target, new, ["id"], update={"price": "s.raised"},
        insert={"id": "s.id", "note": "concat('n', cast(s.raised / 2 AS INT))"},
    )
    assert result.columns == target.columns
    assert rows(result) == sorted(
        [(1, 1.0, "a"), (2, 8.0, "b"), (3, None, "c"), (None, 9.0, "t"), (7, None, "n3"),
         (None, None, "n2")], key=repr,
    )


def test_two_matches_are_an_error(spark, target):
    with pytest.raises(DuplicateMatch):
        merge(target, source(spark, (1, 1.0, "x"), (1, 2.0, "y")), ["id"])


def test_repeated_new_keys_are_all_inserted(spark, target, rows):
    result = merge(target, source(spark, (9, 1.0, "x"), (9, 1.0, "x")), ["id"])
    assert rows(result.where("id = 9")) == [(9, 1.0, "x")] * 2


def test_empty_source_changes_nothing(spark, target, rows):
    assert rows(merge(target, source(spark).where("false"), ["id"])) == rows(target)


def test_update_keeps_types_and_null_predicates(target, rows):
    changed = update_where(target, "price > 1", {"price": "0"})
    assert changed.schema == target.schema
    assert rows(changed, "note", "price") == [("a", 1.0), ("b", 0.0), ("c", None), ("t", 0.0)]


def test_delete_keeps_null_predicates(target, rows):
    assert rows(delete_where(target, "price > 1"), "note") == [("a",), ("c",)]
