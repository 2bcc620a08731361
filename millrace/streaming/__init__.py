"""Structured Streaming flows: batch-addressed sinks, change-data flows, incremental aggregates."""
