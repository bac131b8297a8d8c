"""Reading and writing close tables, CSV landing, and the views over the driver tables."""
