"""Training-data operators (fingerprints, dedup, scoring, tokenising). Nothing else imports this package."""
