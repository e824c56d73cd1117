"""Column functions: text, url, price and field-coercion expressions."""
