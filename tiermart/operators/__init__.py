"""Generic DataFrame operators (clean rules, joins, frame-level helpers, checks)."""
