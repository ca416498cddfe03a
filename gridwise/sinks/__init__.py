"""gridwise.sinks."""
