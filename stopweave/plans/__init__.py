"""The four batch jobs, from input folders to output tables."""
