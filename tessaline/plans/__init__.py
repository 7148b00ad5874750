"""Queries and whole plans: what the operators make together, and how a corpus is synchronised."""
