"""adlens: Spark-native processing of outdoor-advertisement readings."""
