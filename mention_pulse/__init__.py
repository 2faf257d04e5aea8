"""Mention analytics over short social posts, as plain Spark DataFrame functions."""
