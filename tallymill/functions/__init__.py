"""Column expressions: text, numbers and dates. No UDFs; everything stays in codegen."""
