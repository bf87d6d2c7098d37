"""Training-data operators: archives, deduplication, mixing, packing, search, filters.

One module per operator; ``queries`` registers them.  Nothing else in the
library imports this subpackage.
"""
