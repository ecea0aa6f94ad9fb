"""Small parameter tables of the reports."""
