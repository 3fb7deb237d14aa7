"""DataFrame operators: parsing, text preparation, encoding assembly, index
offsets, lookups, partitioning, merging, resharding, blending, chat data."""
