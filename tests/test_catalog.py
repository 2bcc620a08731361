"""Every catalogue query against its SQL counterpart on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

RUNS, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: round(v, 9) if isinstance(v, float) else v
    names = [columns[i] for i in order]
    return names, sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name, data):
    df = RUNS[name](spark, data)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(SQL[name])
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want


def test_sql_names_are_queries():
    assert set(SQL) <= set(RUNS)


def test_entry_runs(spark):
    assert entry.entry(spark).columns[:2] == ["invoice_date", "department"]


def test_zorder_narrows_the_files_to_read(spark, data):
    by_layout = {r["layout"]: r for r in RUNS["zorder_file_overlap"](spark, data).collect()}
    assert by_layout["clustered"]["files_read"] < by_layout["arrival"]["files_read"]


def test_range_layout_has_disjoint_files(spark, data):
    files = sorted(
        (r["min_o_orderdate"], r["max_o_orderdate"])
        for r in RUNS["file_skipping_profile"](spark, data).collect()
    )
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))
