"""barlake: Spark-native medallion analytics for market OHLCV bars.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from the public
PySpark DataFrame / SQL / Structured Streaming APIs. No UDFs, no actions inside
operators; wall-clock values (``run_ts``, ``asof``) are explicit arguments.
"""

__version__ = "0.1.0"
