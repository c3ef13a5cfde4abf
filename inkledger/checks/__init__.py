"""Registered queries: the star-schema tables mapped to invoice documents, with SQL twins."""
