"""Table operators: DataFrame in, DataFrame out, nothing collected unless its size is bounded."""
