"""Spark jobs that build and audit a bibliographic corpus."""
