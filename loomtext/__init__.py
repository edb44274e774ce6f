"""A Spark-native engine for building instruction-tuning datasets from long-form text."""
