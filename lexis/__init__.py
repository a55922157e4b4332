"""lexis: labelled-text analytics on Spark DataFrames."""
