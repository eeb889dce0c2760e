"""Training-data operators: ten corpus cleaning and scoring jobs and their registered queries."""
