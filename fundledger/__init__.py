"""Fund holdings and company filings analytics on Spark DataFrames."""
