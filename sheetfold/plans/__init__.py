"""End-to-end jobs: finance, budget, timesheets; and the named query registry."""
