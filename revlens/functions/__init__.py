"""Column helpers: dates (UTC), text, numbers and the token-set similarity score."""
