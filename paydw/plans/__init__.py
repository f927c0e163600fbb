"""Jobs: the warehouse ETL and the analytics questions asked of it."""
