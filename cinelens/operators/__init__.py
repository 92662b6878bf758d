"""DataFrame operators: validation, preparation, features, factorization, profiles, scoring, recommendation, evaluation, profiling."""
