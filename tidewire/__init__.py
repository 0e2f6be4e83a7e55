"""Spark-native content-lake analytics: bronze -> silver -> gold -> versioned core -> reports."""
