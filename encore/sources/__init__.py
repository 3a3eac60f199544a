"""Reading raw tables and the base table, writing the base table, staging."""
