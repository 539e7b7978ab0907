"""Column-expression builders: money, dates, text and loan formulas."""
