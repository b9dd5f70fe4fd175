"""Part of gradus."""
