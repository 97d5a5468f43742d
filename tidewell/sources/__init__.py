"""Reading: message streams, change records, dimension tables and word lists."""
