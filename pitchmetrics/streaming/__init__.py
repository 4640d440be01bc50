"""Structured Streaming: record ingestion with foreachBatch, live metrics, live ratings."""
