"""Column-level building blocks (rule registries compiled to CASE, month arithmetic, text)."""
