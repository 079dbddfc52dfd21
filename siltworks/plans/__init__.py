"""Parameters of a run: layers of policy, themes and directions, merged before any plan is built."""
