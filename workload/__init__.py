"""The driver tables reshaped into clinical form, the registered queries and their oracle SQL."""
