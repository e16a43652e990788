"""Table operators for clinical data, written as Spark expressions and plans."""
