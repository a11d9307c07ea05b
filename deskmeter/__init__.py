"""Support-desk SLA analytics as Spark DataFrame operators."""
