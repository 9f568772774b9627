"""DataFrame operators: conforming, deduplication, cleaning, model, quality reports."""
