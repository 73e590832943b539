"""Row-local work on streams."""
