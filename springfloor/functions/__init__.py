"""See README.md for what this layer holds."""
