"""Readers of stored tables and the domain views derived from them."""
