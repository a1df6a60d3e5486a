"""DataFrame operators: cleaning, sampling, encoding, models, selection, metrics."""
