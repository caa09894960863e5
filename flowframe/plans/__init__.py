"""Plan building blocks: ordered numbering, step composition, scratch space."""
