"""Steps, their wiring, and the query registry."""
