"""DataFrame-to-DataFrame operators: cleaning, splitting, deduplicating, shaping, increments."""
