"""End-to-end plans: the star schema and its reports."""
