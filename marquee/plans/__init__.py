"""Plans: stand-in inputs derived from the test tables and end-to-end catalogue flows."""
