"""The warehouse: applicant features, dimensions and facts, the end-to-end run."""
