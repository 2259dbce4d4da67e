"""Zone-to-zone data pipelines on Spark DataFrames."""
