"""The pipeline is batch only; ``gold_stream`` offers its Gold grains incrementally."""
