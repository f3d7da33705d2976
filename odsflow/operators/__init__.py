"""DataFrame-to-DataFrame steps: conform, quality, metadata, changes."""
