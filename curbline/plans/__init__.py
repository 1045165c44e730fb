"""The jobs: replay batches, bronze, silver, gold and reports."""
