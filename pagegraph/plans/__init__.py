"""Registered queries, the tables they derive, and the SQL that checks them."""
