"""Read plans over a store."""
