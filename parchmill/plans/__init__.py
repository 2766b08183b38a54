"""Query plans over the operators."""
