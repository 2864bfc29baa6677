"""Reading: file listings, JSON envelopes and lake tables."""
