"""The operators at work on the given tables, next to SQL that gives the same rows."""
