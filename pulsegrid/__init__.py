"""Spark-native analytics over daily, ranked and partly censored page attention."""
