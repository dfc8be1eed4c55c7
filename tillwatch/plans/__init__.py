"""Named reports and checked queries."""
