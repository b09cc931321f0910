"""End-to-end jobs composed of operators, and the catalogue of example queries."""
