"""Scans: landed raw records, domain search, Bronze ranges, control runs."""
