"""Reading tables, publishing reports and reading them back."""
