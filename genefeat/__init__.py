"""Genome-feature data work as Spark DataFrame plans."""
