"""Reading and writing catalog tables."""
