"""Compositions of the operators: ingests, loaders, registered queries."""
