"""gridwise.functions."""
