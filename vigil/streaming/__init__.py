"""Scoring appended data: the batch scorecard applied per micro-batch."""
