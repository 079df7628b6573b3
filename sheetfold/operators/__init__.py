"""Operators: sheet layout, header naming, joins, dense ids, unions, audit counts."""
