"""A Spark-native engine for record linkage and corpus preparation."""
