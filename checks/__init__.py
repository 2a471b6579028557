"""Plain SQL that says what each query must return."""
