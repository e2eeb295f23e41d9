"""Column functions: decoding of stored text, text shaping and markup extraction."""
