"""shopflow: a Spark-native retail analytics engine.

Layers (each a package):

* ``functions`` – Column expressions (casts, blank tests, enum maps, ISO text).
* ``sources``   – scans: CSV, JSON lines, file discovery, cursor scans, topics,
                  and adapters from the driver's TPC-H-like tables.
* ``operators`` – DataFrame -> DataFrame building blocks: cleaning, event
                  validation, keyed merges, message envelopes, quality checks.
* ``sinks``     – versioned table writes, ledger / cursor state, publishing.
* ``plans``     – composite queries: the five reports and the landing layer.
* ``streaming`` – Structured Streaming drivers (file arrival, landing,
                  incremental reports).
"""

__version__ = "0.1.0"
