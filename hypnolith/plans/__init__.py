"""The mart as a whole: its tables, its queries and their SQL equivalents."""
