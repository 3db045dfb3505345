"""Query plans: SQL models, the query registry and its oracle SQL."""
