"""Dataset operators: DataFrame in, DataFrame out."""
