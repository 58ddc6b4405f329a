"""Training-data operators: sharding, quality filter, packing, licence scan,
fingerprints, line dedup, decontamination, exact-substring dedup, token files
and n-gram Jaccard join. Nothing outside this subpackage imports it."""
