"""Tidewright: Spark jobs for pipeline run logs, pipeline lineage and a retail warehouse."""

__version__ = "0.1.0"
