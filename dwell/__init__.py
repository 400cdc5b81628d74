"""Visit profiles and exposure minutes from stay records, as lazy Spark DataFrames."""
