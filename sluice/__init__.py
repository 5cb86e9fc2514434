"""sluice: a Spark-native engine for profiling, checking, repairing, masking and releasing tables."""
