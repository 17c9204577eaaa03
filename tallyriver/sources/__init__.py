"""Readers: event envelopes, JDBC tables, CSV and incremental reads."""
