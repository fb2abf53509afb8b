"""Registered queries over the test tables and their reference SQL."""
