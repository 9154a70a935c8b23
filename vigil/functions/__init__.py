"""Column-level building blocks: rules as Columns, expected dates, ordered text aggregation."""
