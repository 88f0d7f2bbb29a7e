"""Column expressions: text, URLs and HTML events."""
