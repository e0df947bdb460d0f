"""The live feed as an incremental stream."""
