"""Multi-step jobs that chain operators: building, labelling, reporting."""
