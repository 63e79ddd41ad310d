"""Compositions of operators into the work the agents and the overview do."""
