"""Paged record sources: page numbers are the parallel unit, page bodies become rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def fetch_pages(
    spark: SparkSession, pages: int, fetch: Callable[[int], str], parallelism: int = 64
) -> DataFrame:
    """(page, body): ``fetch`` runs in the tasks, one call per page, never on the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"page": batch["id"], "body": [fetch(int(n)) for n in batch["id"]]})

    numbers = spark.range(0, pages, 1, max(1, min(parallelism, pages)))
    return numbers.mapInPandas(run, "page LONG, body STRING")


def page_records(
    pages: DataFrame, body: str, record: T.StructType | str, field: str = "records"
) -> DataFrame:
    """One row per record of page bodies shaped ``{field: [record, ...]}``."""
    item = f"STRUCT<{record}>" if isinstance(record, str) else record.simpleString()
    parsed = F.from_json(body, f"STRUCT<{field}: ARRAY<{item}>>")
    return pages.select(F.inline(parsed.getField(field)))
