"""Writers: partition overwrite, keyed merges, versioned dimensions."""
