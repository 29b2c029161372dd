"""Writers: lake streams, keyed tables, outgoing records."""
