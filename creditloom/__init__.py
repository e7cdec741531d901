"""A credit-risk analytics engine on Spark DataFrames."""
