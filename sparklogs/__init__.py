"""Log-pipeline jobs as plain functions from DataFrame to DataFrame."""
