"""Live readings: source, parsing, state and micro-batch sink."""
