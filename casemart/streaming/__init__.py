"""casemart.streaming."""
