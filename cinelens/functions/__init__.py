"""Column expressions: text cleaning, tokenizing, vector maths."""
