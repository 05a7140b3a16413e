"""Operators for training data made from transcripts. Nothing else imports this."""
