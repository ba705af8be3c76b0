"""The registered queries: which shared table carries which operator, and the SQL beside it."""
