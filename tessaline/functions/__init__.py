"""Column functions: everything here is an expression of built-in functions, so it stays inside code generation."""
