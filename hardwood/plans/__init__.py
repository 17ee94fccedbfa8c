"""Table builds and the order they run in."""
