"""Training-data operators: deduplication, decontamination, quality, tokens, archives, PII, chats, pages."""
