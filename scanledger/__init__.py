"""Account intelligence over internet-scan observations, on Spark DataFrames."""
