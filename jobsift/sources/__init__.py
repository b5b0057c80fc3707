"""Readers and writers: landed JSON/HTML pages, backups, JDBC tables."""
