"""DataFrame operators: quantiles, splits, profiles, features, encoders, metrics, models."""
