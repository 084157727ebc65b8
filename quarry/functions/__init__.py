"""Column-level helpers: every function returns a Spark ``Column`` built from
built-in expressions, so it stays inside whole-stage code generation."""
