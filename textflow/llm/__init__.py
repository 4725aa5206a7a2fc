"""Training-data operators: dedup, tokens, decontamination, language ID ..."""
