"""Query operators: every function takes DataFrames and returns one."""
