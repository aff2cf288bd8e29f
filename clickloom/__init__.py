"""Spark-native feature engineering, modelling and evaluation for tables with a binary response."""
