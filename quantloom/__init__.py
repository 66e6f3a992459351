"""Batch jobs over daily equity panels, as DataFrame operators on Spark."""
