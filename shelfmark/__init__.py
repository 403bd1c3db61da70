"""shelfmark: saved review pages in, clean and checked review tables out, on Spark."""
