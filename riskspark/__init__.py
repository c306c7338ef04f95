"""riskspark: security-risk analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames. Fitted operators follow
the ``fit`` / ``transform`` split of Spark ML: ``fit`` runs a few bounded
aggregates and keeps only scalars (or a small written table), ``transform`` is a
projection over literals and stays lazy.
"""
