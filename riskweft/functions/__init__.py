"""Column expressions: every function here returns a Column or adds columns in one projection."""
