"""Commercial-analytics operators and plans as plain Spark DataFrame code."""
