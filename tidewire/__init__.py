"""A PySpark-native engine that collects, normalises, routes, merges and audits news-style records."""
