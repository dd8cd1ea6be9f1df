"""Column functions: typing, JSON, text, dates, links and business rules."""
