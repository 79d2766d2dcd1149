"""Column functions: built-in expressions first, Arrow UDFs for HTML entities and Unicode normal forms."""
