"""Query plans over the test tables: fixtures, registered queries and
their oracle SQL."""
