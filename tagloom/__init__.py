"""tagloom: Spark-native processing of industrial tag readings.

Raw readings become canonical, idempotent events: sampling on a time grid,
dimension resolution, quality classification, partitioned sinks, merges and
streams, all as DataFrame operators.
"""

__version__ = "0.1.0"
