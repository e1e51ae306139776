"""DataFrame operators: time series, aggregates, normalisation, ranking, resolution."""
