"""DataFrame -> DataFrame operators: joins, aggregations, windows, flattening."""
