"""Column expressions; none of them moves a row between partitions."""
