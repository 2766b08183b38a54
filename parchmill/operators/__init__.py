"""Operators over DataFrames: normalizing, chunking, indexing, retrieval, answering."""
