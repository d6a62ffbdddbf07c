"""Sources: JSON-lines logs with row offsets, the checkpoint log, the events adapter."""
