"""Column functions: text clean-up, rule labels, response parsing."""
