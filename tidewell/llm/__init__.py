"""Training-data operators: sharding, quality, licences, decontamination, archives,
near-duplicates, search, chat formatting, tokenizing and line deduplication.

Nothing else in the library imports this subpackage."""
