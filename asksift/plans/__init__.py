"""End-to-end jobs made of the operators, with stage tables in between."""
