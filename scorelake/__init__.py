"""Credit-risk scoring and model monitoring on Spark DataFrames."""

__version__ = "0.1.0"
