"""marquee: catalogue ingest, cleaning and analytics as plain Spark DataFrame jobs.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and is built only
from native Spark expressions, so batch tables and Structured Streaming inputs share
the same code.
"""

__version__ = "0.1.0"
