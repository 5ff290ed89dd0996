"""Progress state and the optional streaming front."""
