import json
import os

import pytest

from millrace import scratch
from millrace.functions.json import infer_json_schema
from millrace.sources import evolution
from millrace.sources.evolution import NewColumns, SchemaStore
from millrace.sources.files import list_files, read_csv, read_files
from millrace.sources.ingest import ingest_files, ingest_json, read_ingested
from millrace.sources.jdbc import jdbc_options, newer_than
from millrace.sources.loads import copy_into, read_loaded
from millrace.sources.paged import fetch_pages, page_records
from millrace.streaming.flows import append_flow, batch_flow, read_batches, trigger_options


def drop(path, *records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)


def run(spark, folder, mode=evolution.ADD, **options):
    ingest_json(spark, f"{folder}/in", f"{folder}/out", f"{folder}/ck", mode=mode, **options)
    return read_ingested(spark, f"{folder}/out", f"{folder}/ck", mode)


def test_each_file_once_across_runs(spark, folder, rows):
    drop(f"{folder}/in/a.json", {"id": 1, "x": 1.5}, {"id": 2, "x": 2})
    assert rows(run(spark, folder), "id", "x") == [(1, 1.5), (2, 2.0)]
    drop(f"{folder}/in/b.json", {"id": 3, "x": None})
    run(spark, folder)
    assert rows(run(spark, folder), "id", "x") == [(1, 1.5), (2, 2.0), (3, None)]


def test_new_column_is_added_and_old_rows_read_null(spark, folder, rows):
    drop(f"{folder}/in/a.json", {"id": 1})
    run(spark, folder)
    drop(f"{folder}/in/b.json", {"id": 2, "tag": "t", "deep": {"n": [1, 2]}})
    result = run(spark, folder)
    assert rows(result, "id", "tag") == [(1, None), (2, "t")]
    assert result.where("id = 2").first()["deep"]["n"] == [1, 2]
    assert SchemaStore(spark, f"{folder}/ck").load().names == ["id", "deep", "tag"]


def test_rescue_keeps_what_does_not_fit(spark, folder, rows):
    drop(f"{folder}/in/a.json", {"id": 1})
    run(spark, folder, evolution.RESCUE)
    drop(f"{folder}/in/b.json", {"id": "two", "tag": "t"}, "not json")
    result = run(spark, folder, evolution.RESCUE)
    rescued = sorted(r[0] or "" for r in result.select(evolution.RESCUED).collect())
    assert rescued == ["", '{"_corrupt_record":"not json"}', '{"id":"two","tag":"t"}']
    assert result.count() == 3


def test_odd_records_do_not_spoil_the_schema(spark, folder, rows):
    drop(f"{folder}/in/a.json", {"id": 1, "a b": 2, "x-y": {"o.p": 1.5}}, "[1, 2]", "", '{"id": 2, "id": 3}')
    result = run(spark, folder)
    assert SchemaStore(spark, f"{folder}/ck").load().names == ["a b", "id", "x-y"]
    assert result.count() == 3
    assert result.where("id = 1").select("`x-y`.`o.p`").first()[0] == 1.5
    assert rows(result.where(f"{evolution.RESCUED} LIKE '%[1, 2]%'"), "id") == [(None,)]


def test_nested_fields_evolve_too(spark, folder, rows):
    drop(f"{folder}/in/a.json", {"id": 1, "who": {"n": 1}, "items": [{"s": "a"}]})
    run(spark, folder)
    drop(f"{folder}/in/b.json", {"id": 2, "who": {"n": 2, "m": "x"}, "items": [{"s": "b", "q": 5}]})
    result = run(spark, folder)
    assert rows(result, "id", "who.m", "items.q", evolution.RESCUED) == [
        (1, None, [None], None), (2, "x", [5], None),
    ]


def test_nested_misfits_are_rescued_whole(spark, folder, rows):
    good = {"id": 1, "who": {"n": 1, "z": None}, "items": [{"s": 1}, None]}
    drop(f"{folder}/in/a.json", good)
    run(spark, folder, evolution.RESCUE)
    drop(
        f"{folder}/in/b.json", {"id": 2, "who": {"n": "two"}, "items": [{"s": 2, "extra": True}]},
        {"id": 3, "who": {"n": None}, "items": []}, {"id": 4, "who": "nobody"},
    )
    result = run(spark, folder, evolution.RESCUE)
    assert rows(result, "id", evolution.RESCUED) == [
        (1, None),
        (2, '{"who":"{\\"n\\":\\"two\\"}","items":"[{\\"s\\":2,\\"extra\\":true}]"}'),
        (3, None),
        (4, '{"who":"nobody"}'),
    ]


def test_names_that_differ_in_case_are_rescued(spark, folder, rows):
    drop(f"{folder}/in/a.json", {"id": 1})
    run(spark, folder)
    drop(f"{folder}/in/b.json", {"ID": 2, "Tag": "t", "tAG": "u"})
    result = run(spark, folder)
    assert SchemaStore(spark, f"{folder}/ck").load().names == ["id", "Tag"]
    assert rows(result, "id", "Tag", evolution.RESCUED) == [
        (1, None, None), (None, "t", '{"ID":"2","tAG":"u"}'),
    ]


def test_failed_batch_is_replayed_without_duplicates(spark, folder, rows):
    """The first run dies after writing its batch, before the checkpoint commits it."""
    drop(f"{folder}/in/a.json", {"id": 1}, {"id": 2})
    stream = lambda: spark.readStream.schema("id LONG").json(f"{folder}/in")

    def broken(batch):
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch_id=0")
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        batch_flow(stream(), f"{folder}/out", f"{folder}/ck", shape=broken)
    batch_flow(stream(), f"{folder}/out", f"{folder}/ck")
    assert rows(read_batches(spark, f"{folder}/out"), "id") == [(1,), (2,)]


def test_none_ignores_new_fields(spark, folder):
    drop(f"{folder}/in/a.json", {"id": 1})
    run(spark, folder, evolution.NONE)
    drop(f"{folder}/in/b.json", {"id": 2, "tag": "t"})
    result = run(spark, folder, evolution.NONE)
    assert result.columns == ["id", "_source_file", "_load_time"] and result.count() == 2


def test_fail_mode_stops_before_writing(spark, folder):
    drop(f"{folder}/in/a.json", {"id": 1})
    run(spark, folder, evolution.FAIL)
    drop(f"{folder}/in/b.json", {"id": 2, "tag": "t"})
    with pytest.raises(Exception) as caught:
        run(spark, folder, evolution.FAIL)
    assert NewColumns.__name__ in str(caught.value)
    assert read_ingested(spark, f"{folder}/out", f"{folder}/ck").count() == 1


def test_hints_override_inference(spark, folder):
    drop(f"{folder}/in/a.json", {"id": 1, "at": "2024-01-02 03:04:05"})
    result = run(spark, folder, hints="id STRING, at TIMESTAMP_NTZ")
    assert dict(result.dtypes)["at"] == "timestamp_ntz" and dict(result.dtypes)["id"] == "string"
    assert result.first()["at"].hour == 3


def test_unknown_mode(spark, folder):
    drop(f"{folder}/in/a.json", {"id": 1})
    with pytest.raises(Exception, match="unknown evolution mode"):
        run(spark, folder, "sometimes")


def test_stored_schema_survives_for_other_formats(spark, folder, rows):
    drop(f"{folder}/in/a.csv", "id,x", "1,a")
    ingest_files(spark, f"{folder}/in", "csv", f"{folder}/out", f"{folder}/ck", header=True)
    drop(f"{folder}/in/b.csv", "id,x", "2,b")
    ingest_files(spark, f"{folder}/in", "csv", f"{folder}/out", f"{folder}/ck", header=True)
    result = read_ingested(spark, f"{folder}/out", f"{folder}/ck", evolution.NONE)
    assert rows(result, "id", "x") == [(1, "a"), (2, "b")]


def test_copy_into_loads_each_file_once(spark, folder, rows):
    src, target, ledger = f"{folder}/in", f"{folder}/t", f"{folder}/l"
    drop(f"{src}/a.json", {"id": 1})
    assert copy_into(spark, target, src, "json", ledger=ledger) == 1
    assert copy_into(spark, target, src, "json", ledger=ledger) == 0
    drop(f"{src}/b.json", {"id": 2})
    assert copy_into(spark, target, src, "json", ledger=ledger) == 1
    assert rows(read_loaded(spark, target, ledger)) == [(1,), (2,)]


def test_copy_into_takes_many_files_in_pages(spark, folder, rows):
    src, target, ledger = f"{folder}/in", f"{folder}/t", f"{folder}/l"
    for i in range(7):
        drop(f"{src}/{i}.json", {"id": i})
    load = lambda: copy_into(spark, target, src, "json", ledger=ledger, max_files=3)
    assert load() == 7 and load() == 0
    assert rows(read_loaded(spark, target, ledger)) == [(i,) for i in range(7)]
    assert len(os.listdir(ledger)) == 3


def test_copy_into_recovers_from_a_load_without_ledger_entry(spark, folder, rows):
    src, target, ledger = f"{folder}/in", f"{folder}/t", f"{folder}/l"
    drop(f"{src}/a.json", {"id": 1})
    copy_into(spark, target, src, "json", ledger=ledger)
    drop(f"{src}/b.json", {"id": 2})
    spark.createDataFrame([(99,)], "id LONG").write.parquet(f"{target}/load_id=1")
    assert rows(read_loaded(spark, target, ledger)) == [(1,)]
    copy_into(spark, target, src, "json", ledger=ledger)
    assert rows(read_loaded(spark, target, ledger)) == [(1,), (2,)]


def test_copy_into_needs_permission_for_new_columns(spark, folder, rows):
    src, target, ledger = f"{folder}/in", f"{folder}/t", f"{folder}/l"
    drop(f"{src}/a.json", {"id": 1})
    copy_into(spark, target, src, "json", ledger=ledger)
    drop(f"{src}/b.json", {"id": 2, "tag": "t"})
    with pytest.raises(ValueError, match="merge_schema"):
        copy_into(spark, target, src, "json", ledger=ledger)
    assert copy_into(spark, target, src, "json", ledger=ledger, merge_schema=True) == 1
    assert rows(read_loaded(spark, target, ledger), "id", "tag") == [(1, None), (2, "t")]


def test_multiline_is_explicit(spark, folder):
    drop(f"{folder}/in/a.csv", "id,note", '1,"two', 'lines"', "2,one")
    read = lambda multiline: read_csv(
        spark, f"{folder}/in", "id INT, note STRING", multiline=multiline
    )
    assert read(True).count() == 2 and read(False).count() == 3


def test_listing_reads_no_contents(spark, folder):
    drop(f"{folder}/in/x/a.json", {"id": 1})
    files = list_files(spark, f"{folder}/in")
    assert files.count() == 1 and "content" not in files.columns


def test_unsupported_format(spark, folder):
    with pytest.raises(ValueError):
        read_files(spark, folder, "xlsx")


def test_pages_are_fetched_in_tasks(spark, rows):
    def fetch(page):
        return json.dumps({"records": [{"id": page * 10 + i} for i in range(3)]})

    records = page_records(fetch_pages(spark, 5, fetch), "body", "id LONG")
    assert rows(records) == sorted([(p * 10 + i,) for p in range(5) for i in range(3)], key=repr)


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "orders", column="id", lower=1, upper=10_000_000)
    assert options["numPartitions"] == "8" and options["fetchsize"] == "10000"
    assert "partitionColumn" not in jdbc_options("jdbc:x", "orders")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "orders", column="id")
    assert newer_than("orders", "at", "2024-01-01") == (
        "(SELECT * FROM orders WHERE at > '2024-01-01') newer"
    )


def test_triggers():
    assert trigger_options("availableNow") == trigger_options("once") == {"availableNow": True}
    assert trigger_options("30 seconds") == {"processingTime": "30 seconds"}
    assert trigger_options("continuous 1 second") == {"processingTime": "1 second"}


def test_interval_trigger_keeps_running_until_stopped(spark, folder):
    drop(f"{folder}/in/a.json", {"id": 1})
    rows = spark.readStream.schema("id LONG").json(f"{folder}/in")
    query = append_flow(rows, f"{folder}/out", f"{folder}/ck", trigger="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(f"{folder}/out").count() == 1


def test_scratch_follows_the_session_setting(spark):
    root = scratch.scratch_root(spark)
    assert scratch.scratch_dir(spark, "x").startswith(root)
    assert scratch.scratch_dir(spark, "x") != scratch.scratch_dir(spark, "x")


def test_streams_downstream_meet_every_row_once(spark, folder, rows):
    """A batch that widens the schema, and batches replayed, must not show again downstream."""
    src, bronze, checkpoint = f"{folder}/src", f"{folder}/bronze", f"{folder}/c"
    seen, follow = f"{folder}/seen", f"{folder}/follow"

    def pull():
        stream = spark.readStream.schema("id LONG, batch_id LONG").parquet(bronze)
        append_flow(stream, seen, follow)

    spark.range(10).write.json(src)
    ingest_json(spark, src, bronze, checkpoint)
    pull()
    spark.range(10, 15).selectExpr("id", "'new' AS extra").write.mode("append").json(src)
    ingest_json(spark, src, bronze, checkpoint)
    pull()
    # a fresh checkpoint offers the first batches again
    ingest_json(spark, src, bronze, f"{folder}/c2")
    pull()
    assert rows(spark.read.parquet(seen), "id") == sorted(((i,) for i in range(15)), key=repr)


def test_indented_objects_take_part_in_the_schema(spark):
    df = spark.createDataFrame([('{"a":1}',), ('\t{"a":2,"b":"x"}',), (' \r\n {"c":1.5}',), ("[1]",)], "value STRING")
    assert infer_json_schema(df, "value").fieldNames() == ["a", "b", "c"]
