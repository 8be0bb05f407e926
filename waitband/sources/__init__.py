"""Sources: driver tables, the derived wide extract, the specialty seed,
ZIP/CSV archives, file manifests and release pages."""
