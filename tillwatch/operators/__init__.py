"""Report operators: tables and a clock in, one DataFrame out."""
