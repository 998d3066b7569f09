"""Part of the entityforge package."""
