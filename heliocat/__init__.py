"""Build, merge and query catalogs of time-stamped events on Spark.

Subpackages:

* ``functions``  column expressions (``Column`` in, ``Column`` out)
* ``sources``    readers for the catalog, status rows, feeds and listings
* ``operators``  DataFrame operators: collapse, eras, merges, joins, statistics
* ``plans``      whole pipelines and the read queries built from operators
* ``streaming``  Structured Streaming jobs and the ledger of landed files, on top of the merges

All event times are ``timestamp_ntz`` holding UTC wall-clock time, so no result
depends on the session time zone.
"""
