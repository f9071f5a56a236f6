"""Registered queries: table-level plans composed from the operators."""
