"""Sensor-stream analytics as Spark DataFrame jobs, batch and streaming."""
