"""rowsift: find and measure bad rows in training tables, on Spark.

Every operator is a function from DataFrame to DataFrame. Random choices are
functions of ``(seed, row_id)``, ties break on ``row_id`` and floats that are
sort keys are rounded to ``KEY_DIGITS`` places first, so a rerun or a lost
executor gives the same rows.
"""

__version__ = "0.1.0"
