"""Lakehouse operators written as plain Spark DataFrame functions.

Every operator takes DataFrames, parameters and (where time matters) an explicit ``as_of``
and returns a DataFrame. Reads, writes and clocks stay at the edges (``sources``), so the
same function serves batch jobs and streaming micro-batches.
"""

__version__ = "0.1.0"
