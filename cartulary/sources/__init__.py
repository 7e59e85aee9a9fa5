"""Document and record sources."""
