"""Whole-run plans: mappings, the entity build, sealing, and the built-in sources."""
