"""Relational steps from texts to dictionaries, corpora and topics."""
