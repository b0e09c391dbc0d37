"""retail_spark: Spark-native retail event pipelines.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
built-ins, so it runs unchanged on a batch DataFrame or (where it makes
sense) on a streaming one. No SparkSession is created at import time.
"""

__version__ = "0.1.0"
