"""DataFrame transformations; all lazy."""
