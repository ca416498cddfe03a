"""gridwise.streaming."""
