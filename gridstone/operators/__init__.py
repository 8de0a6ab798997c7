"""Operators over dimensional and panel data; each takes and returns DataFrames and triggers no job."""
