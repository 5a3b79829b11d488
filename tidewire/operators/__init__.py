"""Relational operators: merging, state, windows, joins, audits."""
