"""Operators that a training-data pipeline needs: counting, scanning, encoding, searching, classifying, mixing."""
