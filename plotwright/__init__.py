"""Plotwright: positioned text from drawings, cleaned and reconciled as Spark DataFrames."""
