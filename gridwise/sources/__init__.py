"""gridwise.sources."""
