"""ratecraft: monthly rate-series tables on Spark.

Raw dated rate files are ingested incrementally (``streaming``), conformed
and deduplicated (``operators.conform``), checked (``operators.quality``),
upserted (``operators.upsert``) and rolled up into a monthly mart with
compounded, real and rolling 12-month rates (``operators.mart``).
"""

__version__ = "0.1.0"
