"""Column expressions: text casts and derived trip features."""
