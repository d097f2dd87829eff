"""Table operators: each takes DataFrames and returns DataFrames. One that runs a job says so in its docstring."""
