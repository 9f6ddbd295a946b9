"""Reading raw files, and reading and writing the layers."""
