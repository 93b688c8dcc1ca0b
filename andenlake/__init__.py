"""Passenger-transport ticket analytics on Spark DataFrames."""
