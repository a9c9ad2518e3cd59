"""Column-level building blocks: calendar parts, text clean-up, limit ranges."""
