"""Claim-evidence analytics on Spark DataFrames."""
