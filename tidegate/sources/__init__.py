"""Readers and writers: inbound snapshots, reference data, dated tables, reports."""
