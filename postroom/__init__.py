"""postroom: mailbox and report exports to clean, partitioned tables, on Spark.

Every public operator takes and returns DataFrames (or Columns for the
scalar functions in ``postroom.functions``).
"""

__version__ = "0.1.0"
