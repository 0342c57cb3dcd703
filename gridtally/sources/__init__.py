"""Readers and writers: landed files, keyed logs, JDBC tables, partitioned tier tables."""
