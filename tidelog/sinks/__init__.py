"""Writers for entries, rejects, payloads and progress."""
