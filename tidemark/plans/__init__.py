"""Market tables (M1–M14), driver-table bindings and the query catalog."""
