"""PySpark-native invoice-document analytics: ingest, decide, store, review, report."""
