"""End-to-end jobs: conform and conflate for all counties in one plan."""
