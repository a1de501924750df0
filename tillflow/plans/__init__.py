"""Plans: derived input feeds, POS adapters, the end-to-end pipeline, sinks."""
