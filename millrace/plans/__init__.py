"""Dataset graph and the query catalogue built from the operators."""
