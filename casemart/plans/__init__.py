"""casemart.plans."""
