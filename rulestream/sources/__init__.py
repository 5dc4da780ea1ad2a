"""Reading and writing tables, topics and files."""
