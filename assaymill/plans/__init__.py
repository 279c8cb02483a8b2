"""Compositions of operators: cleaning recipes, the whole run, and the registered queries."""
