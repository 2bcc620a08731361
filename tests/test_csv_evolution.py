import json

import pytest

from millrace.sources import evolution
from millrace.sources.evolution import SchemaStore
from millrace.sources.ingest import ingest_csv, read_ingested


@pytest.fixture()
def drop(folder):
    def write(name, text):
        import os

        os.makedirs(f"{folder}/src", exist_ok=True)
        with open(f"{folder}/src/{name}.csv", "w", encoding="utf-8") as out:
            out.write(text)

    return write


def load(spark, folder, mode, **options):
    ingest_csv(spark, f"{folder}/src", f"{folder}/out", f"{folder}/checkpoint", mode=mode, **options)
    return read_ingested(spark, f"{folder}/out", f"{folder}/checkpoint", mode)


def test_columns_are_found_by_name(spark, folder, drop, rows):
    drop("a", "id,name,price\n1,ann,2.5\n2,\"b, c\",\n")
    load(spark, folder, evolution.ADD)
    drop("b", "price,ID\n7.5,3\n")
    drop("c", "name,id,since\ndan,4,2024-01-02\n")
    found = load(spark, folder, evolution.ADD)
    assert [f.simpleString() for f in found.schema.fields[:4]] == [
        "id:bigint", "name:string", "price:double", "since:date",
    ]
    assert rows(found, "id", "name", "price", "_rescued_data") == [
        (1, "ann", 2.5, None), (2, "b, c", None, None), (3, None, 7.5, None), (4, "dan", None, None),
    ]
    assert str(rows(found.where("id = 4"), "since")[0][0]) == "2024-01-02"


def test_what_does_not_fit_is_rescued(spark, folder, drop, rows):
    drop("a", "id,n\n1,5\n")
    load(spark, folder, evolution.RESCUE)
    drop("b", "n,id,Extra\nmany,2,x\n6,3,\n")
    drop("c", "id,n\n4,7,8\n5\n")
    found = load(spark, folder, evolution.RESCUE)
    assert rows(found, "id", "n") == [(1, 5), (2, None), (3, 6), (4, 7), (5, None)]
    rescued = {r["id"]: json.loads(r["_rescued_data"]) for r in found.where("_rescued_data IS NOT NULL").collect()}
    assert rescued == {2: {"n": "many", "extra": "x"}, 4: {"_corrupt_record": "4,7,8"}, 5: {"_corrupt_record": "5"}}


def test_modes_none_and_fail(spark, folder, drop, rows):
    drop("a", "id\n1\n")
    load(spark, folder, evolution.NONE)
    drop("b", "id,new\nx,1\n")
    found = load(spark, folder, evolution.NONE)
    assert rows(found, "id") == [(1,), (None,)] and "_rescued_data" not in found.columns
    drop("c", "id,other\n3,4\n")
    with pytest.raises(Exception, match="new columns"):
        load(spark, folder, evolution.FAIL)


def test_hints_separator_empty_files_and_odd_headers(spark, folder, drop, rows):
    drop("a", "id;;ID\n1;2;3\n")
    drop("b", "")
    drop("c", "id;;ID\n")
    found = load(spark, folder, evolution.ADD, sep=";", hints="id STRING")
    assert found.columns[:3] == ["id", "_c1", "ID_c2"]
    assert rows(found, "id", "_c1", "ID_c2") == [("1", 2, 3)]
    assert SchemaStore(spark, f"{folder}/checkpoint").load().names == ["id", "_c1", "ID_c2"]
