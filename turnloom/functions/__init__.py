"""Column -> Column functions; row-local, no shuffle."""
