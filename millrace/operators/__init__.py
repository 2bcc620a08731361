"""DataFrame-to-DataFrame operators: joins, dedup, change data, merge, versions, quality, governance."""
