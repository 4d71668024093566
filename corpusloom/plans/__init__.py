"""The four jobs, each one function over DataFrames and paths."""

from corpusloom.plans.mail import extract_messages, mail_job, mail_metadata, mail_tokens
from corpusloom.plans.topics import apply_job, text_job, train_job

__all__ = [
    "apply_job",
    "extract_messages",
    "mail_job",
    "mail_metadata",
    "mail_tokens",
    "text_job",
    "train_job",
]
