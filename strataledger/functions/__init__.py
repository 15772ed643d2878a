"""Column functions: text, dates, numbers and canonical hashing."""
