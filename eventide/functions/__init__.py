"""Column-level helpers: parsing, time conversion, rendering."""
