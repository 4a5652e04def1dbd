"""Compositions of the operators: the staged batch run and the registered queries."""
