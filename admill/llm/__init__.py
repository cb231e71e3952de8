"""Training-data operators: ten corpus-scale steps built on DataFrames."""
