"""Training-data operators: mixing, near-duplicate detection, quality and
language scoring, exact search, passage deduplication, packing, chat rendering
and token matrices.  Nothing else in the library imports this subpackage."""
