"""Incremental (day-by-day) loading.

The attribution chain has no stream operator: late data is handled by
reloading the most recent date partitions on every run.  This package holds
that incremental loader; it keeps durable model tables and advances them one
run date at a time.
"""
