"""Plans made of operators."""
