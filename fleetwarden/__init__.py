"""fleetwarden: fleet-maintenance analytics expressed as Spark DataFrame jobs.

Sub-packages
------------
functions  column-expression helpers (flags, identifier quoting, sizes, ACLs, slice windows)
sources    readers for tables, catalog snapshots and log-directory listings
operators  the DataFrame -> DataFrame operators (fleet, catalog, bloat, ledger, slicing, grants)
streaming  Structured Streaming variants (continuous slicing, event-log append)
plans      stand-in inputs shaped from the driver tables, composite runs and the query registry
"""

__version__ = "0.1.0"
