"""Moves new order records from a relational table into a date-partitioned Parquet lake."""
