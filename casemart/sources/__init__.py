"""casemart.sources."""
