"""Column expressions and Arrow batch functions."""
