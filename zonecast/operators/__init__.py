"""DataFrame operators: history, features, contracts, models, monitoring."""
