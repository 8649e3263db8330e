"""lodestar: DataFrame operators for building and maintaining industry-record sets.

Every public operator takes and returns Spark DataFrames (or Columns) and is
expressed with native Spark SQL expressions so Catalyst can prune, push down
and code-generate the work.
"""

__version__ = "0.1.0"
