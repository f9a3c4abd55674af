"""Models, their selection and their evaluation."""
