"""Column expressions: all built from native functions, so they stay in codegen."""
