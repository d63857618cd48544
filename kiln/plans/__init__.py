"""Composed jobs: daily sensor ETL, the three-stage chain, the credit run."""
