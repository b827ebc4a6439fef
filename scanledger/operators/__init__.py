"""DataFrame in, DataFrame out: the operators of each layer."""
