"""Query plans: derived fixtures, the registered query catalogue and the SQL
oracles that check it."""
