"""fairweave: event-listing integration on Spark DataFrames."""
