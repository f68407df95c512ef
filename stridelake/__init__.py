"""Spark-native analytics over wearable minute data: medallion tables, features, decisions, reports."""
