"""Relational operators of the job, each a DataFrame -> DataFrame function."""
