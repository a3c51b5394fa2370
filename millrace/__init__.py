"""Extract, change-capture and job-timing operators for Spark DataFrames."""
