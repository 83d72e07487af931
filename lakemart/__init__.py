"""lakemart: a layered (bronze / silver / gold) data-lake library on Spark DataFrames."""

__version__ = "0.1.0"
