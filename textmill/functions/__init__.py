"""Column functions: native expressions, with Arrow batches only for codecs and byte repair."""
