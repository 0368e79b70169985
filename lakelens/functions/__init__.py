"""Column-level helpers and order/rank building blocks."""
