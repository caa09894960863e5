"""The operators wired to the test tables, each with the same statement in SQL."""
