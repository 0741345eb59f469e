"""Training-data operators: sharding, chat formatting, language models, deduplication,
decontamination, extraction and token output. Nothing outside this package imports it."""
