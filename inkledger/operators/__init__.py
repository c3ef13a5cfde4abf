"""Document and table operators: DataFrame in, DataFrame out."""
