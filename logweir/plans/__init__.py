"""Complete jobs built from the operators."""
