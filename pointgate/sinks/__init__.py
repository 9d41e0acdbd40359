"""Writers of accepted points and of the dead letter."""
