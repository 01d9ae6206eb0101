"""Column expressions: cleaning, scoring, status texts, energy."""
