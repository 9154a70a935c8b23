"""Operators of a training-data pipeline.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries when it is present.  Every operator takes DataFrames and returns
DataFrames; intermediate tables go to the folder the session names in
``spark.checkpoint.dir``.
"""
