"""Table-to-table transformations."""
