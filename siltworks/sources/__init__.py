"""Session files in two dialects, and header-named tables."""
