"""Readers for files, layers, JDBC tables and landing folders."""
