"""DataFrame-to-DataFrame operators; all lazy, all built-in expressions."""
