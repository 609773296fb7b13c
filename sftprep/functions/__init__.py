"""Column expressions: text slots, chat templates, tokenizers."""
