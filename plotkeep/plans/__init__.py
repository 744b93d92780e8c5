"""Compositions of operators: the refresh run and the registered queries."""
