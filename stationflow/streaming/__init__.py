"""Structured Streaming: ETL, current state, query control."""
