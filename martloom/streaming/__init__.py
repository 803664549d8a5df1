"""The feeds as streams, arrival rates and the near-real-time load."""
