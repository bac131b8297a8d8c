"""Column expressions shared by the operators. All are Spark built-ins, no UDF."""
