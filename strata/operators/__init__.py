"""DataFrame operators: roll-ups, statistics, features, models, evaluation."""
