"""millrace: layered-table, ingestion, change-data and data-quality jobs on plain PySpark."""
