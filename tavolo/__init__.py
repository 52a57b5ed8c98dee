"""tavolo: table and stream jobs on Spark.

Every job is a function from DataFrames to a DataFrame. Sources live in
``tavolo.sources``, column expressions in ``tavolo.functions``, the jobs in
``tavolo.operators``, the registry of named queries in ``tavolo.plans`` and
the Structured Streaming forms in ``tavolo.streaming``.
"""

__version__ = "0.1.0"
