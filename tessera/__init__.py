"""Tessera: a Spark-native engine for document events, their records and their rankings."""
