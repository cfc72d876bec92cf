"""User-level operators: windowed aggregations, roll-ups, insights, keyed merges."""
