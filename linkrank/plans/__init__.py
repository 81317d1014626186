"""Plans that write tables and run iterations: graph build, ranking, whole run."""
