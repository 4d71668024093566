"""corpusloom: from mails and texts to dictionaries, corpora and topic models on Spark."""
