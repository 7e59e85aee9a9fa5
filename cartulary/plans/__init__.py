"""End-to-end plans and the registry of demonstration queries."""
