"""Pedestrian-count, weather and holiday analytics as Spark DataFrame jobs."""
