"""Sources: topic streams, stored records and raw frames."""
