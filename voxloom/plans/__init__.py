"""End-to-end plans: build a source, merge sources, report on a corpus."""
