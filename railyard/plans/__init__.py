"""Shared pieces of query plans: the table mapping and the dimension joins."""
