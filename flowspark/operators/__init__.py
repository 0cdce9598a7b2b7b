"""DataFrame to DataFrame operators; those without aggregation also take streams."""
