"""Table operators: every operator takes and returns DataFrames."""
