"""Column functions: text, clock and arithmetic building blocks."""
