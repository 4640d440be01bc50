"""Sinks: canonical parquet tables and JSON exports."""
