"""Scheduled ingestion: availableNow file streams feed the batch rebuild (the reference has no streaming)."""
