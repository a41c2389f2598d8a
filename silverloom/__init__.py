"""silverloom: consolidation and reporting operators for multi-source business data, on Spark DataFrames."""

__version__ = "0.1.0"
