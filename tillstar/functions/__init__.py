"""Column builders shared by all reports."""
