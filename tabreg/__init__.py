"""tabreg: tabular-regression analytics on Spark DataFrames.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects (or is a
``pyspark.ml`` Estimator / Transformer). Column names are parameters; no
operator hard-codes a data set's columns.

Sub-packages
------------
sources    CSV / Parquet scans and sinks, the codebook table, driver-table stand-ins
functions  Column-expression helpers, pandas UDFs, small driver-side numerics
operators  cleaning, missingness, profiling, relating, features, matrix, split,
           models, tuning, evaluation, scoring
plans      the registered query catalogue (Spark side and the SQL oracle)
streaming  scoring of a streaming DataFrame with a fitted model
"""

__version__ = "0.1.0"
