"""Business operators: DataFrame in, DataFrame out."""
