"""Column-level functions: event derivations, keys, statuses, messages."""
