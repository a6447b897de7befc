"""The jobs bound to the test tables: input views, queries and their SQL."""
