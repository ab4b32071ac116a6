"""sparkexp: experimentation and model-operations analytics on Spark DataFrames.

Every public operator takes a DataFrame plus column names and returns a lazy
DataFrame. Aggregating operators accept ``group_cols`` so one job answers the
question for every experiment / segment / candidate at once.
"""

__version__ = "0.1.0"
