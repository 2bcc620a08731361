"""Functions over groups of any size: ordered chunks with state carried from one to the next."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows of a chunk; a task holds one chunk and one group's state.
CHUNK_ROWS = 50_000
#: Rows gathered from chunks that give few before they go out, so small groups share a batch.
OUT_ROWS = 10_000


def map_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fn: Callable[[tuple, object, pd.DataFrame | pa.RecordBatch], tuple[object, pd.DataFrame | list[tuple]]],
    schema: str,
    *,
    finish: Callable[[tuple, object], pd.DataFrame | list[tuple]] | None = None,
    chunk_rows: int = CHUNK_ROWS,
    frames: bool = True,
) -> DataFrame:
    """Apply ``fn`` to every group, a chunk of ordered rows at a time.

    ``fn(key, state, chunk)`` gets None as the state of a group's first chunk and returns the state
    for the next one with the rows to give out; ``finish(key, state)`` gives a group's last rows. One
    shuffle by key; the sort within it spills, and no group is ever held whole, so a group larger
    than a task's memory works. Rows with NULL keys form a group like others. A chunk never spans
    groups. The order should be total: rows equal in it may come in any order.

    Chunks and rows are DataFrames. Making those takes longer than most work on a few rows, so for
    many small groups or chunks give ``frames=False``: a chunk is then an Arrow batch, without a copy,
    and rows are lists of tuples in the order of ``schema``.
    """
    kinds = df.sparkSession.createDataFrame([], schema).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, open_ = None, None, False
        held: list[tuple] = []

        def out(rows: pd.DataFrame | list[tuple]) -> Iterator[pa.RecordBatch]:
            if frames:
                if len(rows):
                    yield pa.RecordBatch.from_pandas(rows[kinds.names], schema=kinds, preserve_index=False)
                return
            held.extend(rows)
            if len(held) >= OUT_ROWS:
                yield from flush()

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [pa.array(c, kind.type) for c, kind in zip(zip(*held), kinds, strict=True)]
                held.clear()
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

        for batch in batches:
            keyed = list(zip(*(batch.column(k).to_pylist() for k in keys)))
            start = 0
            while start < len(keyed):
                end = start + 1
                while end < len(keyed) and keyed[end] == keyed[start] and end - start < chunk_rows:
                    end += 1
                if not open_ or keyed[start] != key:
                    if open_ and finish:
                        yield from out(finish(key, state))
                    key, state, open_ = keyed[start], None, True
                chunk = batch.slice(start, end - start)
                state, rows = fn(key, state, chunk.to_pandas() if frames else chunk)
                yield from out(rows)
                start = end
        if open_ and finish:
            yield from out(finish(key, state))
        yield from flush()

    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, schema)
