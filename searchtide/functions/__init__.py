"""Column functions: text cleaning, dates, classifier replies and rules."""
