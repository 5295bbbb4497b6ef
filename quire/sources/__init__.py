"""Sources: table scans, object scans, event and JSON envelopes."""
