"""Readers and writers at the edges: landed extracts, JDBC, envelopes, day tables, snapshots, exports."""
