"""Readers and writers: reference lists, search payloads, news tables, stage tables, files."""
