"""ontoloom: a PySpark-native engine for knowledge-graph data processing."""
