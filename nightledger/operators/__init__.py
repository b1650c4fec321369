"""Relational operators the reports are assembled from; every one takes and returns DataFrames."""
