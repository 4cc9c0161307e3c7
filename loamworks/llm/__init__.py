"""Training-data operators: ten DataFrame operators over documents and pages, and their queries."""
