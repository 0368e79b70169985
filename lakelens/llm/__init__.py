"""Training-data operators: sharding, near-dedup, language-model scores,
license scans, quality rules, source mixing, exact-substring dedup, benchmark
decontamination, toxicity, personal data, ranked lexical search, centroid
clustering and embedding near-dedup.  Nothing else in the library
imports this subpackage."""
