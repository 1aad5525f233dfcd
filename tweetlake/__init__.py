"""tweetlake: text, JSON, feature and model operators as plain Spark DataFrame functions.

Every public function takes DataFrames (or a SparkSession plus a path) and returns
DataFrames; the work is declared with the DataFrame/SQL API and ``pyspark.ml`` so that
Catalyst plans it and the cluster runs it.
"""

__version__ = "0.1.0"
