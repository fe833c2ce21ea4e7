"""Named queries, their SQL oracles and the end-to-end workflow."""
