"""Record-linkage operators: DataFrame in, DataFrame out, lazy."""
