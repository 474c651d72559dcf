"""See the package docstring and README.md."""
