"""Batch operators: DataFrame in, DataFrame out, nothing evaluated on the driver unless stated."""
