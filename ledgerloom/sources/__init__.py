"""Readers and writers: CSV files, catalog tables, DDL scripts."""
