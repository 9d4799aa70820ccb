"""Scans: landed files, snapshots, JDBC, paged API, literal seeds."""
