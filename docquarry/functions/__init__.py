"""Column-level building blocks: analysis, scoring arithmetic, field access."""
