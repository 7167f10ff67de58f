"""Queries that bind the operators to the supplied tables, each with its SQL twin."""
