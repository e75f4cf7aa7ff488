"""Column expressions: parsing, null tests and text formatting."""
