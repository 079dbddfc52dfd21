"""Column functions over text, and the fixed values that they use."""
