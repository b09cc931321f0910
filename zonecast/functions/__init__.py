"""Column helpers, exact order statistics and reproducible sampling."""
