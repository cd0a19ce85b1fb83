"""Files in and out: landed vendor bars, listings, the bar store, the catalog, snapshots."""
