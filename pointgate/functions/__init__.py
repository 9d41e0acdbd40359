"""Column functions: numbers, times, JSON access, payload shaping."""
