"""DataFrame operators: joins, aggregates, windows, intervals, vectors, statistics."""
