"""Bulk deposit staging on Spark.

Every operator is a plain function over DataFrames (or Columns) built from
built-in Spark expressions, so Catalyst can push filters down, prune columns
and keep the work inside whole-stage codegen.
"""

__version__ = "0.1.0"
