"""tablemint: heterogeneous table deliveries to linked, validated entities, on Spark.

The package is a library of DataFrame operators.  Nothing here owns a session, a
scheduler or a storage layer: every operator takes DataFrames and returns DataFrames,
and Catalyst decides how they run.
"""

__version__ = "0.1.0"
