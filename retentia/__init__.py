"""retentia -- retention analytics on Spark.

Customer-month snapshots with point-in-time features and a forward churn label,
calibrated ``pyspark.ml`` scores, budgeted targeting policies, and their
evaluation, comparison, backtesting, explanation and drift monitoring -- all as
DataFrame operators.

Packages: ``sources`` (scans, sinks, publication), ``functions`` (column helpers),
``operators`` (the operator library), ``plans`` (jobs, registered queries, table
views), ``streaming`` (incremental event roll-up).
"""

__version__ = "0.1.0"
