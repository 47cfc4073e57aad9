"""Training-data operators: one module per operator, gathered by ``catalog``."""
