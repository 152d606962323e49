"""Plans: read queries over metric tables and profiles, and the batch jobs."""
