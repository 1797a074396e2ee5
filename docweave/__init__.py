"""Part of the docweave engine."""
