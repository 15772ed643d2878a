"""Reading and registering lake files, incremental reads, table writes."""
