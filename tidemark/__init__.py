"""tidemark: snapshot tables on Spark, from raw extracts to history, metrics and search.

Every operator is a plain function from DataFrames to DataFrames built on Spark
SQL built-ins.  Planning, shuffling and spilling are left to Catalyst and AQE.
"""

__version__ = "0.1.0"
