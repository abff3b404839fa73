"""Reading documents and tables, and where results are kept."""
