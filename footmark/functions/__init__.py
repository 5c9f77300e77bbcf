"""Column functions: WKB geometry kernels, text parsers, projection, plus codes."""
