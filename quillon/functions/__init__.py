"""Column functions on vectors, images and texts."""
