"""Column expressions. Every function takes and returns a Column."""
