"""Column functions. All are plain expressions, so Catalyst sees through them."""
