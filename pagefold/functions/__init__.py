"""Column-level building blocks: each function takes and returns a Spark Column."""
