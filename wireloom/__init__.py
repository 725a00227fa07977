"""Spark jobs that assemble HTTP trace log lines into events and import partner members."""
