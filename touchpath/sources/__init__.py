"""Readers and writers: event shards, ad-account tables, sampling, sinks."""
