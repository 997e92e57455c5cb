"""casemart.operators."""
