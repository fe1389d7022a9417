"""pelagos: maritime analytics on Spark SQL and DataFrames."""
