"""etlkit: table and stream processing functions for PySpark.

Every function takes and returns ``DataFrame`` and stays lazy unless its
docstring says that it runs a job.
"""
