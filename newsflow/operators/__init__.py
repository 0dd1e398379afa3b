"""DataFrame operators: normalise, filter, rank, join, aggregate, store, extract, check."""
