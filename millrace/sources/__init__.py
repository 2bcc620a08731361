"""Readers: files, schema-evolving file streams, idempotent loads, JDBC, paged records."""
