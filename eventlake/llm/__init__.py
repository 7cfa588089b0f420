"""Training-data operators: extraction, classification, deduplication, tokenisation, sharding.

Nothing outside this subpackage imports it.  Every operator is a function from
DataFrames to a DataFrame; ``registry`` holds the queries built on them.
"""
