"""Bronze / silver / gold table definitions, the analytical questions, and the
wiring that composes them into one lazily planned pipeline."""
