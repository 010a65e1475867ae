"""Column expressions: text, rules, protection and record formatting."""
