"""Query modules; importing the package fills the catalogue."""

from millrace.plans.queries import (  # noqa: F401
    aggregates,
    changes,
    flows,
    governance,
    ingestion,
    joins,
    layout,
    quality,
    rows,
    scalars,
    sources,
    tables,
)
