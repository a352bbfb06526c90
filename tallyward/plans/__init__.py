"""The composed cohort pipeline and its measures."""
