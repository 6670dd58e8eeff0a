"""quire: page-oriented document processing on Spark DataFrames."""

__version__ = "0.1.0"
