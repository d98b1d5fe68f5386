"""Streaming: sinks, and the job that feeds the table."""
