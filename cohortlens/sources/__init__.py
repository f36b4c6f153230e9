"""Raw source contracts, readers, sinks and the fixture projection from the driver tables."""
