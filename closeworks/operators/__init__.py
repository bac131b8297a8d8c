"""DataFrame-in, DataFrame-out operators of the close."""
