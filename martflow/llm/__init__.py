"""Training-data operators (scoring, dedup, formatting, packing ...).

Nothing else in the library imports this subpackage; it can be removed as a
whole.
"""
