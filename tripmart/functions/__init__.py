"""Column functions built only from Spark built-ins."""
