"""Pure column expressions: no I/O, no shuffles."""
