"""DataFrame-to-DataFrame operators; every one works on all symbols at once."""
