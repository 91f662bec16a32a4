"""DataFrame-to-DataFrame operators: dimensions, fact, quality, marts."""
