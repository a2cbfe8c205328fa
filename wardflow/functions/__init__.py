"""Column-expression helpers (all built-in Spark expressions, codegen-friendly)."""
