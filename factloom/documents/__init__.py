"""Documents: plain-Python readers of filed HTML, and their DataFrame forms in `operators`."""
