import pytest

from millrace.operators import versions

KEYS = ["id"]


@pytest.fixture()
def log(spark):
    def commit(rows, version, ts, op):
        return versions.as_commit(spark.createDataFrame(rows, "id LONG, v STRING"), version, ts, op)

    return (
        commit([(1, "a"), (2, "b")], 0, "2024-01-01 00:00:00", "insert")
        .unionByName(commit([(1, "A")], 1, "2024-01-02 00:00:00", "update"))
        .unionByName(commit([(2, "b")], 2, "2024-01-09 00:00:00", "delete"))
        .unionByName(commit([(3, "c"), (2, "z")], 3, "2024-01-10 00:00:00", "insert"))
    )


def test_every_version_reads_back(log, rows):
    expected = [
        [(1, "a"), (2, "b")],
        [(1, "A"), (2, "b")],
        [(1, "A")],
        [(1, "A"), (2, "z"), (3, "c")],
    ]
    for version, want in enumerate(expected):
        assert rows(versions.as_of(log, KEYS, version=version)) == want


def test_timestamp_read_takes_commits_up_to_it(log, rows):
    assert rows(versions.as_of(log, KEYS, timestamp="2024-01-01 23:59:59")) == [(1, "a"), (2, "b")]
    assert rows(versions.as_of(log, KEYS, timestamp="2023-01-01 00:00:00")) == []


def test_either_version_or_timestamp(log):
    with pytest.raises(ValueError):
        versions.as_of(log, KEYS)


def test_restore_writes_only_the_difference(log, rows):
    restored = versions.restore(log, KEYS, 1, 4, "2024-01-11 00:00:00")
    assert rows(versions.as_of(restored, KEYS, version=4)) == [(1, "A"), (2, "b")]
    assert rows(restored.where("commit_version = 4"), "id", "op") == [(2, "update"), (3, "delete")]
    assert rows(versions.as_of(restored, KEYS, version=3)) == [(1, "A"), (2, "z"), (3, "c")]


def test_prune_keeps_reads_inside_the_window(log, rows):
    pruned = versions.prune(log, KEYS, 168)
    assert pruned.count() < log.count()
    for ts in ("2024-01-03 00:00:00", "2024-01-09 12:00:00", "2024-01-10 00:00:00"):
        assert rows(versions.as_of(pruned, KEYS, timestamp=ts)) == rows(
            versions.as_of(log, KEYS, timestamp=ts)
        )


def test_history_counts(log, rows):
    assert rows(versions.history(log), "commit_version", "op", "rows") == [
        (0, "insert", 2), (1, "update", 1), (2, "delete", 1), (3, "insert", 2),
    ]
