"""Query plans: prepare (E1), profile (E2), analysis (E3)."""
