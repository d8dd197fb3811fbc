"""Batch trip-record analytics expressed as Spark DataFrame operators."""
