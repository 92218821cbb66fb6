"""Registered queries: each key has a builder and, where SQL can say it, the same query as SQL text."""
