"""Cantus: a Spark-native track lake, mood classifier and contextual ranker."""
