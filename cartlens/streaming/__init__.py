"""Plans over event files as they arrive."""
