"""A Spark-native entity-catalog engine: sources, column functions, operators, plans and sinks."""
