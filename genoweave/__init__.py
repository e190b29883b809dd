"""Analytics over genome alignments, variants and intervals on Spark DataFrames."""
