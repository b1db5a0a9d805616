"""Column functions: value maps, text, encoders."""
