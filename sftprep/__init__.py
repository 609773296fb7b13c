"""Preparation and scoring of instruction-tuning data as Spark DataFrame jobs."""
