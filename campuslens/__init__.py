"""campuslens: a Spark-native school ranking and dashboard pipeline.

Every public function maps DataFrames to DataFrames and stays lazy; the
only actions are explicit writes (snapshots, table versions, stream sinks)
and small size checks before a broadcast.
"""

__version__ = "0.1.0"
