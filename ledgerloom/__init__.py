"""ledgerloom: DataFrame operators and jobs for retail-style analytics on Spark.

Every public callable takes and returns DataFrames (or builds a Column), changes no
session setting and runs no action, except the sinks and ``curate_retail``, which write, and
``read_csv`` without a schema, which reads the input to infer one.
"""

__version__ = "0.1.0"
