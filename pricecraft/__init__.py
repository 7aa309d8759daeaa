"""pricecraft: Spark-native feature engineering, profiling and regression toolkit.

Every operator is a function over ``pyspark.sql.DataFrame`` / ``Column``;
the work runs as Spark jobs (scans, aggregations, joins, windows).
"""

__version__ = "0.1.0"
