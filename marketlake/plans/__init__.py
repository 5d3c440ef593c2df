"""Compositions of operators: normalisation, dimensions, facts, analytics,
jobs, and the catalog of driver queries."""
