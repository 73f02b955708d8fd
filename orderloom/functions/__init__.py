"""Column-level functions: typing, text and date handling."""
