"""Named queries over the fixture tables, and the same queries as plain SQL."""
