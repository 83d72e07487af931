"""Composite jobs: fixtures, bronze, silver, gold, serving, conforming, deriving, word count."""
