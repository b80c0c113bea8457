"""Table plans: DataFrame in, DataFrame out, with an explicit as-of time."""
