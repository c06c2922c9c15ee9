"""Column functions: text cleanup, dates, prompt building and answer parsing."""
