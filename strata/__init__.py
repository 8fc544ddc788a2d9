"""strata — a Spark-native medallion engine for versioned business records.

Raw nested source records are normalised with column expressions, landed
append-only in a month-partitioned Bronze layer, pulled incrementally by an
inclusive high-watermark cursor with a run log, and served as a deduplicated
current-state Silver layer.  Everything is DataFrame / Structured Streaming
work planned by Catalyst; there are no Python UDFs on the data path.
"""

__version__ = "0.1.0"
