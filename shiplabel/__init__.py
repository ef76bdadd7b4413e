"""Labelling of free-text shipment records as Spark DataFrame jobs."""
