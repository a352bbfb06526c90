"""Column functions: text, dates, predicates and labels."""
