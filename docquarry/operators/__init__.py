"""Queries, facets, highlights, suggestions, sorting and paging on DataFrames."""
