"""Training-data operators: sharding, search, clean-up, identification and tokens."""
