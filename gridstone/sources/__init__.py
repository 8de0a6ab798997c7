"""Reading statistical cubes and writing tables."""
