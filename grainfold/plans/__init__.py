"""The eleven queries, over DataFrames and from file to file."""
