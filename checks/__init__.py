"""Registered queries and their SQL twins over the test tables."""
