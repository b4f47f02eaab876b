"""Spark-native collections analytics: history features, targets, decisions, plans, profiles."""
