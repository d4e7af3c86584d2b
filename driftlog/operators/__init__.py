"""DataFrame operators: folds (anchored windows, token bucket, numbering), joins, search, decoding."""
