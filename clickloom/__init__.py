"""clickloom: event-log analytics as plain Spark DataFrame functions."""
