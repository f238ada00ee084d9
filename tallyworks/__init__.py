"""Advertising, review and page-event analytics as plain Spark DataFrame functions."""
