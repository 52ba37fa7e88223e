"""Relational operators of the pipeline: dedupe, joins, cleaning, rules, star, marts."""
