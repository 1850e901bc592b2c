"""Curation, linkage and audit of document collections on PySpark."""
