"""Column-level building blocks: every function returns a ``Column`` made of
built-in Spark expressions, so it stays inside whole-stage codegen."""
