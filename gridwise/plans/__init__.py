"""gridwise.plans."""
