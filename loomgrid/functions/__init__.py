"""Column functions: clocks, arrays, text, images."""
