"""pickwise: recommendation and ranking operators on Spark DataFrames.

Every operator is a plain function from DataFrame(s) to a DataFrame, built on
Spark SQL / pyspark.ml.  Nothing is collected to the driver.
"""

__version__ = "0.1.0"
