"""File streams that feed the same operators as the batch path."""
