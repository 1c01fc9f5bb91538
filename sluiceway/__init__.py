"""Medallion analytics for utility operations data, written as plain Spark DataFrame functions."""
