"""Models of the star and the questions asked of it."""
