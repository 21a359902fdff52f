"""Test city derived from the ``part`` table, its queries, and the SQL that checks them."""
