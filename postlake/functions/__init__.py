"""Pure column expressions: every function takes columns and returns columns."""
