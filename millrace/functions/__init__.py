"""Column expressions: text checks, classification, time arithmetic, JSON helpers, trend forecast."""
