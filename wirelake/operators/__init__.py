"""Relational building blocks shared by the jobs."""
