"""Column expressions shared by the operators. All are built-in, so they stay in codegen."""
