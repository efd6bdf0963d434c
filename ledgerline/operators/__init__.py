"""Table operators: DataFrame in, DataFrame out, built from native Spark expressions."""
