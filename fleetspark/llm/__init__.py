"""Training-data operators: sharding, packing, classifiers, decontamination,
deduplication, extraction, quality rules and archives. Nothing else in the
library imports this subpackage."""
