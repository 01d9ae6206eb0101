"""Raw sources and stored layers."""
