"""Writers: typed tables, partitioned files, range replacement, upserts."""
