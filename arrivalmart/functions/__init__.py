"""Column-level building blocks: fixed codes, bands, size checks."""
