"""Reading and writing of catalog tables, key files and items."""
