"""Column functions: typed JSON access, text rules, guarded arithmetic, display text."""
