"""pixelframe — land-cover analytics on embedding-pixel tables, built on Spark DataFrames."""

__version__ = "0.1.0"
