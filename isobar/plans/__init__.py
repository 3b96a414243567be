"""Queries, marts, metrics, dashboard aggregates and whole-table jobs."""
