"""The jobs, one module per family; each takes and returns DataFrames."""
