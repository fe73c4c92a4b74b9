"""Column builders made of Catalyst built-ins."""
