"""Training-data operators: filters, near-duplicates, packing, mixing, encoding, search.

Nothing outside this subpackage imports it. Each module holds one operator with its general
interface; ``registry`` holds the thin queries over the driver tables."""
