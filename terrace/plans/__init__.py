"""Query plans: analog extracts, the pure medallion flow, registered queries and multi-step jobs."""
