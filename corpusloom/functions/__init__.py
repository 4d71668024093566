"""Column expressions: mail headers, mail bodies, text cleaning and words."""
