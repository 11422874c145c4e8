"""Dialogue-data preparation and response evaluation on Spark DataFrames."""
