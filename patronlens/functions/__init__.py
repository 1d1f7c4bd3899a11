"""Column helpers shared by all layers."""
