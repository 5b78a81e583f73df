"""Reading tables, writing partitions and publishing results."""
