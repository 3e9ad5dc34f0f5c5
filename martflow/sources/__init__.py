"""Feeds, tables and the retail inputs derived from them."""
