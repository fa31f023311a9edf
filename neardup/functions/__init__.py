"""Column functions over vectors and the embedding of text."""
