"""DataFrame -> DataFrame operators; fitting is one or a few aggregations."""
