"""Inputs derived from the test tables, the registered queries and their reference SQL."""
