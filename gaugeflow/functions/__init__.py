"""Column-level building blocks: decoding, rounding, display."""
