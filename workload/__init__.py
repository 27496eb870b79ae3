"""The registered queries: payment records derived from the shared test tables, and their oracle."""
