"""User-level jobs: planner (Q1, Q2), airport board (Q3, Q4), tracker (Q5)."""
