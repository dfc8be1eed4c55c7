"""Training-data operators: one module per operator, their checked queries in ``queries``."""
