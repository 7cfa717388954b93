"""pagemill: page blocks in, quality-scored retrieval chunks out, on Spark DataFrames."""

__version__ = "0.1.0"
