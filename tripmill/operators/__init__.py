"""Operators on trip tables: normalizing, cleaning, numbering, additive rollups and checks."""
