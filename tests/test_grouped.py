from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
import pytest

from millrace.operators.grouped import map_groups
from millrace.plans.catalog import CATALOG, bind
from millrace.plans.queries import aggregates


@pytest.mark.parametrize("chunk_rows", [1, 7, 50_000])
def test_state_is_carried_over_chunks(spark, chunk_rows):
    def running(key, state, chunk):
        total = (state or 0) + chunk["v"].cumsum()
        assert chunk["k"].isna().all() or chunk["k"].nunique() == 1
        return int(total.iloc[-1]), pd.DataFrame({"k": chunk["k"], "at": chunk["at"], "total": total, "n": len(chunk)})

    df = spark.range(3000).selectExpr("IF(id % 3 > 0, 'hot', IF(id % 2 = 0, 'cold', NULL)) AS k", "id AS at", "id % 11 AS v")
    found = map_groups(df, ["k"], ["at"], running, "k string, at long, total long, n long", chunk_rows=chunk_rows)
    got = {(r["k"], r["at"]): r["total"] for r in found.collect()}
    assert max(r["n"] for r in found.collect()) <= chunk_rows
    sums, want = {}, {}
    for i in range(3000):
        k = "hot" if i % 3 else "cold" if i % 2 == 0 else None
        sums[k] = sums.get(k, 0) + i % 11
        want[k, i] = sums[k]
    assert got == want


def test_groups_are_finished_once(spark):
    df = spark.range(100).selectExpr("id % 4 AS k", "id AS at", "1L AS v")
    count = lambda key, state, chunk: ((state or 0) + len(chunk), pd.DataFrame())
    done = lambda key, state: pd.DataFrame({"k": [key[0]], "n": [state]})
    found = map_groups(df, ["k"], ["at"], count, "k long, n long", finish=done, chunk_rows=3)
    assert sorted(tuple(r) for r in found.collect()) == [(k, 25) for k in range(4)]
    assert map_groups(df.where("id < 0"), ["k"], ["at"], count, "k long, n long", finish=done).count() == 0


def test_small_chunks_go_out_together(spark):
    def count(key, state, chunk):
        assert isinstance(chunk, pa.RecordBatch) and chunk.num_rows <= 3
        return (state or 0) + chunk.num_rows, [(key[0], at, None) for at in chunk.column("at").to_pylist()]

    df = spark.range(4000).selectExpr("IF(id % 500 = 0, NULL, id % 500) AS k", "id AS at").coalesce(1)
    found = map_groups(
        df, ["k"], ["at"], count, "k long, at long, n long",
        finish=lambda key, state: [(key[0], None, state)], chunk_rows=3, frames=False,
    )
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    ids = [(i % 500 or None, i, None) for i in range(4000)]
    assert got == sorted(ids + [(k or None, None, 8) for k in range(500)], key=repr)


def test_visits_of_small_groups_make_no_frames(spark, folder, monkeypatch):
    """Users with few events, NULLs among them: the right visits, and no DataFrame for a chunk."""
    events, want = [], {}
    for user in [None, *range(100)]:
        at, visit = datetime(2024, 1, 1), 0
        for i in range(50 if user is None else 3 + user % 45):
            pause = [0, 12 * 3600, 12 * 3600 + 1, 60, 90_000][((user or 0) + i * i) % 5]
            at += timedelta(seconds=pause)
            visit += not i or pause > 12 * 3600
            value = None if i % 7 == 3 else i * 1.25
            events.append((len(events), at, user, "view", value, "{}"))
            n, began, _, cents = want.get((user, visit), (0, at, at, 0))
            want[user, visit] = n + 1, began, at, cents + int((value or 0) * 100)
    columns = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, columns).write.parquet(f"{folder}/events.parquet")
    seen = []
    monkeypatch.setattr(aggregates, "map_groups", lambda *a, **k: seen.append((a, k)) or map_groups(*a, **k))
    found = bind(CATALOG["grouped_visits"])(spark, folder).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in found} == want and len(found) == len(want)

    (_, _, _, visits, *_), _ = seen[0]
    monkeypatch.setattr(pd.DataFrame, "__init__", None)
    at = [datetime(2024, 1, 1, h) for h in (0, 13, 14)]
    chunk = pa.RecordBatch.from_pydict({"ts": pa.array(at, pa.timestamp("us")), "cents": [1, 2, 3]})
    state, rows = visits((7,), None, chunk)
    assert rows == [(7, 1, 1, at[0], at[0], 1)]
    assert state[0] == (7, 2, 2, at[1], at[2], 5)
