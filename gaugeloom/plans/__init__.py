"""Collector jobs: each takes landed tables and gives typed reports or points."""
