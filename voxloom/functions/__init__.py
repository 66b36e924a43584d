"""Column functions: text, signal and codecs."""
