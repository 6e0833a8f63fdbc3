"""Spark-first engine for document retrieval, catalogs and pipeline analytics."""
