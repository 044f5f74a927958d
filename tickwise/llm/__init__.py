"""Training-data operators: quality, decontamination, chat, HTML, near-duplicates, PII, secrets, language, mixing."""
