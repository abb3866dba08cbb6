"""Column-expression helpers (JVM-side, codegen friendly)."""
